"""Exact vector search and hard negatives against all pairs, and on the odd cases."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from textvec.llm import angular, cover_tree, int_vectors
from textvec.llm.queries import op11_angular_negatives, op13_cover_tree_search

SCHEMA = (
    "vec_id bigint, embedding array<float>, label int, row string, cell string, distance int, score string, block int"
)


def usable(rows, scale):
    """``vec_id, integers, label`` of the rows that take part."""
    dim = max((len(v) for _, v, _ in rows if v is not None), default=0)
    for key, vector, label in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        yield key, [math.floor(scale * float(np.float32(x))) for x in vector] + [0] * (dim - len(vector)), label


def dot(a, b):
    """The inner product; beyond the range of a long, the end of that range."""
    return min(max(sum(x * y for x, y in zip(a, b, strict=True)), -(2**63)), 2**63 - 1)


def plain_top(rows, k, scale, is_query=lambda key: key % 10 == 0):
    rows = list(usable(rows, scale))
    out = []
    for key, vector, _ in rows:
        if is_query(key):
            scored = sorted((-dot(vector, other), i) for i, other, _ in rows if i != key)
            out += [(key, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def random_rows(seed: int, n: int = 400, dim: int = 6):
    """Clusters, copies, a hot vector, long and zero vectors, and vectors without structure."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = []
    for key in range(n):
        kind = rng.random()
        if kind < 0.3:
            vector = [x + rng.gauss(0, 0.01) for x in rng.choice(centres)]
        elif kind < 0.6:
            vector = centres[0]
        elif kind < 0.65:
            vector = [0.0] * dim
        else:
            vector = [rng.gauss(0, rng.choice([0.1, 1, 30])) for _ in range(dim)]
        rows.append((key, vector, rng.choice([0, 0, 0, 1, 2, 3])))
    return rows


ODD = [
    (None, [1.0, 2.0], 1), (10, None, 1), (20, [1.0, None], 1), (30, [float("nan"), 1.0], 1), (40, [1.0, float("inf")], 0),
    (50, [1.0, 2.0], None), (60, [1.0, 2.0], 1), (60, [1.0, 2.0], 1), (61, [1.0, 2.0], 0), (70, [], 0), (80, [0.5], 0),
    (90, [3e38, -3e38], 1), (91, [-3e38, 3e38], 0), (100, [0.0, 0.0], 1), (110, [-1.0, -2.5], 0), (111, [2.0, 1.0], 0),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "r", "c", 1, "s", 2) for row in rows], SCHEMA).repartition(3)


def test_cover_tree_covers():
    points = np.array([v for _, v, _ in usable(random_rows(1), 64)], dtype=float)
    tree = cover_tree.CoverTree(points, 8)
    points = points[tree.order]
    for node, children in enumerate(tree.children):
        part = points[tree.low[node] : tree.high[node]]
        assert np.linalg.norm(part - tree.centres[node], axis=1).max() <= tree.radii[node] * (1 + 1e-12) + 1e-9
        if children:
            assert [tree.low[c] for c in children[1:]] == [tree.high[c] for c in children[:-1]]
            assert sum(tree.high[c] - tree.low[c] for c in children) == len(part)
        else:
            assert len(part) <= 8 or tree.radii[node] == 0
    assert sorted(tree.order) == list(range(len(points)))


def test_products_are_exact_whatever_their_size():
    a = np.array([[2.0**40, 1.0], [3.0, -4.0], [2.0**70, 2.0**70]])
    b = np.array([[2.0**22, 1.0], [-(2.0**30), 7.0], [2.0**70, -(2.0**70)], [2.0, 5.0]])
    found = int_vectors.products(a, b, int_vectors.lengths(a), int_vectors.lengths(b))
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            assert found[i, j] == dot([int(v) for v in x], [int(v) for v in y])


@pytest.mark.parametrize(("seed", "block_rows", "group_rows", "per_task"), [(1, 50, 8, 2), (2, 1000, 512, 32)])
def test_top_products(spark, monkeypatch, seed, block_rows, group_rows, per_task):
    monkeypatch.setattr(int_vectors, "GROUPS_PER_TASK", per_task)
    monkeypatch.setattr(cover_tree, "ROW_LEAF", 8)
    rows = random_rows(seed)
    table = frame(spark, rows)
    found = cover_tree.top_products(table.where("vec_id % 10 = 0"), table, 7, 64, block_rows, group_rows)
    assert sorted(map(tuple, found.collect())) == plain_top(rows, 7, 64)


def plain_best(queries, query_ids, rows, row_ids, k, floor):
    """``query, id, score`` of the rows that ``search`` has to find, by all pairs."""
    out = []
    for n, (query, key) in enumerate(zip(queries, query_ids, strict=True)):
        scored = sorted((-int(query @ row), int(i)) for row, i in zip(rows, row_ids, strict=True) if i != key)
        out += [(n, i, -s) for s, i in scored[:k] if floor is None or -s >= floor[n]]
    return sorted(out)


@pytest.mark.parametrize("kind", ["scattered", "ties", "clusters", "copies", "one query"])
def test_search_equals_all_pairs(monkeypatch, kind):
    """Repeated ids, equal scores and copies; few products at once, whatever the leaves."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(cover_tree, "ROW_LEAF", 16)
    monkeypatch.setattr(cover_tree, "PAIRS", 500)
    vectors = {
        "scattered": lambda: rng.integers(-1000, 1000, (700, 8)),
        "ties": lambda: rng.integers(-2, 3, (700, 3)),
        "clusters": lambda: rng.integers(-9999, 9999, (6, 8))[rng.integers(0, 6, 700)] + rng.integers(-20, 20, (700, 8)),
        "copies": lambda: np.repeat(rng.integers(-50, 50, (7, 4)), 100, axis=0),
        "one query": lambda: rng.integers(-1000, 1000, (700, 8)),
    }[kind]().astype(float)
    ids = rng.integers(0, 500, 700)
    asked = np.zeros(90, dtype=int) if kind == "one query" else rng.integers(0, 700, 90)
    sizes, products = [], cover_tree.products
    monkeypatch.setattr(cover_tree, "products", lambda *a: sizes.append(len(a[0]) * len(a[1])) or products(*a))
    tree = cover_tree.RowTree(pa.table({"vec_id": pa.array(ids), "vector": int_vectors.list_column(vectors)}))
    for k, floor in ((1, None), (9, None), (9, rng.integers(0, 40, 90))):
        best = int_vectors.Best(90, k, floor)
        cover_tree.search(vectors[asked], ids[asked], tree, best)
        at, found, scores = best.rows()
        rows = [r for r in zip(at.tolist(), found.tolist(), scores.tolist(), strict=True) if floor is None or r[2] >= floor[r[0]]]
        assert sorted(rows) == plain_best(vectors[asked], ids[asked], vectors, ids, k, floor)
    assert max(sizes) <= 500


def test_leaves_that_are_left_are_scored_together(monkeypatch):
    """Without any structure nearly all rows are scored, but not leaf by leaf: some calls for a leaf of queries."""
    rng = np.random.default_rng(5)
    vectors, calls, products = rng.integers(-3000, 3000, (5000, 64)).astype(float), [], cover_tree.products
    monkeypatch.setattr(cover_tree, "products", lambda *a: calls.append(len(a[0])) or products(*a))
    tree = cover_tree.RowTree(pa.table({"vec_id": pa.array(range(5000)), "vector": int_vectors.list_column(vectors)}))
    best = int_vectors.Best(100, 10)
    cover_tree.search(vectors[:100], np.arange(100), tree, best)
    leaves = len(cover_tree.CoverTree(vectors[:100], cover_tree.QUERY_LEAF).leaves())
    assert len(tree.leaves()) > 100 and sum(calls) >= 100 and len(calls) < 0.5 * leaves * len(tree.leaves())
    assert max(calls) > cover_tree.QUERY_LEAF  # and sibling leaves together


def test_search_still_leaves_out_far_clusters(monkeypatch):
    """With structure, leaves of queries that need other rows are scored apart: far fewer pairs than all."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-(10**5), 10**5, (20, 16))
    vectors = (centres[np.arange(4000) % 20] + rng.integers(-50, 50, (4000, 16))).astype(float)
    pairs, products = [], cover_tree.products
    monkeypatch.setattr(cover_tree, "products", lambda *a: pairs.append(len(a[0]) * len(a[1])) or products(*a))
    tree = cover_tree.RowTree(pa.table({"vec_id": pa.array(range(4000)), "vector": int_vectors.list_column(vectors)}))
    best = int_vectors.Best(200, 10)
    cover_tree.search(vectors[:200], np.arange(200), tree, best)
    assert sum(pairs) < 0.25 * 200 * 4000
    at, found, scores = best.rows()
    rows = sorted(zip(at.tolist(), found.tolist(), scores.tolist(), strict=True))
    assert rows == plain_best(vectors[:200], np.arange(200), vectors, np.arange(4000), 10, None)


def test_top_products_of_odd_rows(spark):
    table = frame(spark, ODD)
    found = cover_tree.top_products(table.where("vec_id % 10 = 0"), table, 4)
    assert sorted(map(tuple, found.collect())) == plain_top(ODD, 4, 1024)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]


def test_top_products_of_empty_tables(spark):
    table, none = frame(spark, ODD), frame(spark, [])
    assert cover_tree.top_products(none, table).collect() == []
    assert cover_tree.top_products(table, none).collect() == []
    assert cover_tree.top_products(table.where("vec_id = 60"), table.where("vec_id in (30, 60)")).collect() == []


def same_as_sql(spark, query, oracle, sf_dir="/root/testdata/sf0.001"):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = con.execute(oracle)
    names = [c[0] for c in expected.description]
    found = query(spark, sf_dir).select(*names).collect()
    assert sorted(map(tuple, found)) == sorted(expected.fetchall())
    return len(found)


def test_top_products_query(spark):
    assert same_as_sql(spark, op13_cover_tree_search, cover_tree.ORACLE) == 50


def plain_negatives(rows, n_positives, n_negatives, low, high, scale, is_anchor=lambda key: key % 10 == 0):
    rows = [row for row in usable(rows, scale) if row[2] is not None]
    out = []
    for key, vector, label in rows:
        if is_anchor(key):
            scored = sorted((-dot(vector, other), i, other_label) for i, other, other_label in rows if i != key)
            for p, positive, _ in [x for x in scored if x[2] == label][:n_positives]:
                fitting = [x for x in scored if x[2] != label and low * -p <= 100 * -x[0] <= high * -p]
                out += [(key, positive, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fitting[:n_negatives])]
    return sorted(out)


def test_intervals_hold_the_products():
    rows = list(usable(random_rows(7), 64))
    vectors = np.array([v for _, v, _ in rows], dtype=float)
    size = int_vectors.lengths(vectors)
    directions = angular.references(vectors[:100])
    angles = angular.angles_to(directions, vectors, size)
    least, greatest = angular.score_intervals(angles, size, angles, angles, size, size)
    scores = vectors @ vectors.T
    assert (least <= scores).all() and (scores <= greatest).all()
    assert (greatest - least).mean() < 0.7 * 2 * (size[:, None] * size).mean()  # and they tell something
    low, high = (np.quantile(angles[:50], q, axis=0)[None] for q in (0, 1))
    least, greatest = angular.score_intervals(angles, size, low, high, size[:50].min()[None], size[:50].max()[None])
    assert (least <= scores[:, :50]).all() and (scores[:, :50] <= greatest).all()


def test_windows_are_exact():
    begin, end = angular.score_windows([100, 7, 0, -10, 2**63 - 1], 30, 90)
    assert begin.tolist() == [30, 3, 0, -3, -(-30 * (2**63 - 1) // 100)]
    assert end.tolist() == [90, 6, 0, -9, 90 * (2**63 - 1) // 100]


@pytest.mark.parametrize(("seed", "block_rows", "group_rows", "tile"), [(3, 40, 8, 64), (4, 1000, 512, 1 << 20)])
def test_hard_negatives(spark, monkeypatch, seed, block_rows, group_rows, tile):
    monkeypatch.setattr(angular, "TILE", tile)
    rows = random_rows(seed)
    table = frame(spark, rows)
    found = angular.hard_negatives(table.where("vec_id % 10 = 0"), table, 3, 4, 30, 90, 64, block_rows, group_rows)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 3, 4, 30, 90, 64)


def test_hard_negatives_of_odd_rows(spark):
    rows = [row for row in ODD if row[0] != 60] + [(60, [1.0, 2.0], 1), (62, [0.9, 2.0], 1), (63, [0.5, 0.5], -3)]
    table = frame(spark, rows)
    found = angular.hard_negatives(table.where("vec_id % 10 = 0"), table)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 5, 10, 30, 90, 256)
    repeated = frame(spark, [(10, [1.0, 1.0], 1), (11, [1.0, 0.5], 1), (11, [1.0, 0.5], 1), (12, [0.5, 0.5], 2), (12, [0.5, 0.5], 2)])
    found = angular.hard_negatives(repeated.where("vec_id = 10"), repeated)
    assert sorted((r["positive_id"], r["rank"], r["negative_id"]) for r in found.collect()) == sorted(
        [(11, rank, 12) for rank in (1, 2)] * 2
    )


def test_hard_negatives_of_empty_tables(spark):
    table, none = frame(spark, ODD), frame(spark, [])
    assert angular.hard_negatives(none, table).collect() == []
    assert angular.hard_negatives(table, none).collect() == []
    alone = table.where("vec_id = 61")
    assert angular.hard_negatives(alone, alone).collect() == []


def test_hard_negatives_query(spark):
    assert same_as_sql(spark, op11_angular_negatives, angular.ORACLE) > 100
