"""Exact search for the largest inner products with two cover trees, one of queries and one of rows.

A node of a tree has a centre and a covering radius, the distance to its furthest point. For a query q
in a node with centre c and radius r, and a row p in a node with centre d and radius s,

    q.p <= c.d + |c| s + |d| r + r s.

So a pair of nodes whose bound is below the worst k-th score of the node's queries holds nothing that
counts. The search goes down both trees at once, a node of queries with all nodes of rows that are left for
it, and scores the leaves that are left together.

At scale the upper part of the tree is fitted on a bounded sample; every row and every query goes to
the leaf (the cell) whose centres are nearest on the way down, and cells get their true radii from all
rows. Cells are cut into blocks of rows and groups of queries of bounded size. A group first visits one
block of the cell with the best bound; with the k-th scores found there, its own node pairs with all
cells are pruned, and only the blocks of those that are left are visited.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textvec.llm.int_vectors import (
    EXACT,
    LEAST,
    Best,
    Cut,
    integer_rows,
    lengths,
    longest,
    matrix,
    met,
    packed,
    products,
    unpacked,
)
from textvec.workspace import written

FAN = 16  # children of a node
SAMPLE = 2048  # rows that the upper part of the tree is fitted on
MAX_CELLS = 1024
BLOCK_ROWS, GROUP_ROWS = 16_384, 512
ROW_LEAF, QUERY_LEAF = 128, 16
PAIRS = 1 << 17  # queries times rows whose products are held at once


def _distances(points: np.ndarray, squares: np.ndarray, at: int | np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Distances of ``points[at]`` to a centre; ``squares`` are their squared lengths."""
    chosen, square = points[at], float(centre @ centre)
    if squares[at].max(initial=0.0) < EXACT / 4 and square < EXACT / 4:  # all terms are exact integers
        return np.sqrt(np.maximum(squares[at] + square - 2.0 * (chosen @ centre), 0.0))
    return lengths(chosen - centre)


class CoverTree:
    """Nodes over ranges of the points, which are brought into the order ``order``.

    Children of a node are centred on points of it, chosen the furthest from the chosen ones first,
    until all points are within half of the radius of the nearest or there are ``FAN`` children; the
    first child keeps the centre of its parent. A node with few points, or with copies of one, is a leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int, most_leaves: int | None = None):
        self.order = np.arange(len(points))
        self.low, self.high, self.centres, self.radii = [], [], [], []
        self.children: list[list[int]] = []
        squares = np.einsum("ij,ij->i", points, points)
        leaves = 0
        todo: list[tuple[int, int, np.ndarray]] = []  # the largest first

        def add(low: int, high: int, centre: np.ndarray, distance: np.ndarray) -> int:
            nonlocal leaves
            node = len(self.low)
            self.low.append(low)
            self.high.append(high)
            self.centres.append(centre)
            self.radii.append(float(distance.max(initial=0.0)))
            self.children.append([])
            leaves += 1
            if high - low > leaf and self.radii[node] > 0:
                heapq.heappush(todo, (low - high, node, distance))
            return node

        if len(points):
            add(0, len(points), points[0], _distances(points, squares, self.order, points[0]))
        while todo and (most_leaves is None or leaves < most_leaves):
            _, node, nearest = heapq.heappop(todo)
            low, high = self.low[node], self.high[node]
            at = self.order[low:high]
            centres, owner = [self.centres[node]], np.zeros(high - low, dtype=np.int64)
            fan = FAN if most_leaves is None else min(FAN, most_leaves - leaves + 1)
            while len(centres) < fan and nearest.max() > self.radii[node] / 2:
                furthest = int(nearest.argmax())
                distance = _distances(points, squares, at, points[at[furthest]])
                closer = distance < nearest
                owner[closer], nearest = len(centres), np.where(closer, distance, nearest)
                centres.append(points[at[furthest]])
            by_owner = np.argsort(owner, kind="stable")
            self.order[low:high] = at[by_owner]
            nearest, ends = nearest[by_owner], np.cumsum(np.bincount(owner, minlength=len(centres)))
            leaves -= 1
            for centre, begin, end in zip(centres, [0, *ends[:-1]], ends, strict=True):
                if end > begin:
                    self.children[node].append(add(low + int(begin), low + int(end), centre, nearest[begin:end]))
        self.centres = np.array(self.centres).reshape(len(self.low), points.shape[1])
        self.radii = np.array(self.radii)
        self.norms = lengths(self.centres)

    def leaves(self) -> list[int]:
        return [node for node, children in enumerate(self.children) if not children]

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf of each point, by its number in ``leaves()``, and the distance to its centre."""
        number = {node: i for i, node in enumerate(self.leaves())}
        squares = np.einsum("ij,ij->i", points, points)
        cell, distance = np.zeros(len(points), dtype=np.int32), np.zeros(len(points))
        todo = [(0, np.arange(len(points)))] if len(self.low) else []
        while todo:
            node, at = todo.pop()
            children = self.children[node]
            if not children:
                cell[at], distance[at] = number[node], _distances(points, squares, at, self.centres[node])
                continue
            each = np.stack([_distances(points, squares, at, self.centres[c]) for c in children])
            nearest = each.argmin(axis=0)
            todo += [(c, at[nearest == i]) for i, c in enumerate(children) if (nearest == i).any()]
        return cell, distance


def _bounds(a, a_norm, a_radius, b, b_norm, b_radius) -> np.ndarray:
    """Upper bounds of the products of points in balls around ``a`` and points in balls around the rows
    of ``b``, rounded up by more than the arithmetic can be off."""
    with np.errstate(all="ignore"):
        size = (a_norm + a_radius) * (b_norm + b_radius)
        bound = b @ a + a_norm * b_radius + b_norm * a_radius + a_radius * b_radius + 1e-9 * size + 1e-6
        return np.where(np.isnan(bound), np.inf, bound)


class RowTree(CoverTree):
    """The tree of a block, with its vectors and ids in the order of the tree."""

    def __init__(self, block: pa.Table):
        vectors = matrix(block["vector"])
        super().__init__(vectors, ROW_LEAF)
        self.vectors, self.ids = vectors[self.order], block["vec_id"].to_numpy()[self.order]
        self.lengths = lengths(self.vectors)


def _strips(low: np.ndarray, high: np.ndarray, most: int) -> list[tuple[int, int]]:
    """The ranges from ``low`` to ``high`` as few strips of at most ``most`` rows: those that adjoin as one."""
    order = np.argsort(low)
    low, high = low[order], high[order]
    apart = low[1:] != high[:-1]
    begins, ends = low[np.append(True, apart)].tolist(), high[np.append(apart, True)].tolist()
    return [(i, min(i + most, end)) for begin, end in zip(begins, ends, strict=True) for i in range(begin, end, most)]


def search(queries: np.ndarray, query_ids: np.ndarray, r: RowTree, best: Best) -> None:
    """Offer ``best`` all rows that can be among the best of a query. A row with the query's id does not count.

    A node of queries goes down the tree of rows with all nodes that are left for it at once, and its
    children go on with those. A leaf of queries first looks at the leaves of rows with the best bounds for a
    score that it needs at least, and scores all leaves that are not ruled out then, as one strip where they
    adjoin; sibling leaves that are left with about the same rows score them together."""
    if not len(queries) or not len(r.order):
        return
    q = CoverTree(queries, QUERY_LEAF)
    rows, row_ids, row_lengths = r.vectors, r.ids, r.lengths
    row_low, row_high, inner = np.array(r.low), np.array(r.high), np.array([bool(c) for c in r.children])
    # queries are renumbered inside their tree; needed and found stay with the caller's numbers
    query_lengths = lengths(queries)

    def members(a: int) -> np.ndarray:
        return q.order[q.low[a] : q.high[a]]

    def left(a: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of rows that can hold something for a query of node ``a``, and their bounds."""
        each = _bounds(q.centres[a], q.norms[a], q.radii[a], r.centres[nodes], r.norms[nodes], r.radii[nodes])
        kept = each >= best.needed[members(a)].min()
        return nodes[kept], each[kept]

    def down(a: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same below ``nodes``: leaves, and for a node of queries that has children smaller nodes than it."""
        nodes, each = left(a, nodes)
        while len(nodes):
            split = inner[nodes]
            if q.children[a]:
                split &= r.radii[nodes] >= q.radii[a]
            if not split.any():
                break
            children, bounds = left(a, np.concatenate([r.children[b] for b in nodes[split]]))
            nodes, each = np.append(nodes[~split], children), np.append(each[~split], bounds)
        return nodes, each

    def size(nodes: np.ndarray) -> int:
        return int((row_high[nodes] - row_low[nodes]).sum())

    def expect(mine: np.ndarray, nodes: np.ndarray) -> None:
        """Raise what queries need to their k-th score among some rows of ``nodes``, which all come to be scored."""
        ahead = nodes[: int(np.searchsorted(np.cumsum(row_high[nodes] - row_low[nodes]), ROW_LEAF)) + 1]
        at = np.concatenate([np.arange(row_low[b], row_high[b]) for b in ahead])
        at = at[: min(2 * ROW_LEAF, PAIRS // len(mine))]
        if len(at) >= best.k:
            scores = products(queries[mine], rows[at], query_lengths[mine], row_lengths[at])
            scores[query_ids[mine, None] == row_ids[None, at]] = LEAST
            least = np.partition(scores, len(at) - best.k, axis=1)[:, len(at) - best.k]
            best.needed[mine] = np.maximum(best.needed[mine], least)

    def score(mine: np.ndarray, nodes: np.ndarray) -> None:
        for low, high in _strips(row_low[nodes], row_high[nodes], max(1, PAIRS // len(mine))):
            scores = products(queries[mine], rows[low:high], query_lengths[mine], row_lengths[low:high])
            hits = scores >= best.needed[mine, None]
            for i in np.flatnonzero(hits.any(axis=1)):
                at = np.flatnonzero(hits[i])
                at = at[row_ids[low + at] != query_ids[mine[i]]]
                best.offer(mine[i], scores[i, at], row_ids[low + at])

    todo = [(0, np.zeros(1, dtype=np.int64))]
    while todo:
        a, nodes = todo.pop()
        if q.children[a]:
            nodes, _ = down(a, nodes)
        if not len(nodes):
            continue
        below = q.children[a] or [a]
        todo += [(c, nodes) for c in below if q.children[c]]
        parts = []
        for c in (c for c in below if not q.children[c]):
            found, each = down(c, nodes)
            if len(found):
                expect(members(c), found[np.argsort(-each)])
                found, _ = left(c, found)
            if len(found):
                parts.append((members(c), found))
        if len(parts) > 1:
            mine, union = np.concatenate([m for m, _ in parts]), np.unique(np.concatenate([n for _, n in parts]))
            if 2 * sum(len(m) * size(n) for m, n in parts) >= len(mine) * size(union):
                parts = [(mine, union)]
        for mine, found in parts:
            score(mine, found)


FOUND = "found array<struct<row:bigint,query_id:bigint,vec_id:bigint,score:bigint>>"


def _answer(query: pa.Table, best: Best) -> list[dict]:
    at, ids, scores = best.rows()
    rows, query_ids = query["row"].to_numpy()[at], query["vec_id"].to_numpy()[at]
    return [
        {"row": r, "query_id": q, "vec_id": i, "score": s}
        for r, q, i, s in zip(rows.tolist(), query_ids.tolist(), ids.tolist(), scores.tolist(), strict=True)
    ]


def top_products(
    queries: DataFrame,
    table: DataFrame,
    k: int = 10,
    scale: int = 1024,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``queries`` the ``k`` rows of ``table`` (all, if
    fewer) with the largest inner products of the vectors floor(``scale`` * x); ties go to smaller ids.

    Both tables have ``vec_id`` and ``embedding``; further columns are ignored. A row with the query's
    ``vec_id`` is not among its answers. Rows with a null ``vec_id`` take no part, nor do vectors that are
    null, have a null or non-finite component, or overflow when scaled. Shorter vectors count as filled
    up with zeros. Repeated rows are answers of their own, and repeated queries have answers of their
    own. Scores are exact; one beyond the range of a long counts as the end of that range. Where either
    table has no usable row there are no answers.
    """
    spark = table.sparkSession
    queries, table = (t.where("vec_id is not null").selectExpr("cast(vec_id as bigint) vec_id", "embedding") for t in (queries, table))
    dim, n_rows = longest(queries, table)

    plain = integer_rows(table, scale, dim)
    chosen = plain.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).select("vector").toArrow()
    none = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not len(chosen):
        return none
    top = CoverTree(matrix(chosen["vector"]), 1, max(1, min(MAX_CELLS, -(-2 * n_rows // block_rows))))
    cells = top.leaves()

    def placed(vectors: np.ndarray) -> dict[str, pa.Array]:
        cell, distance = top.cells(vectors)
        return {"cell": pa.array(cell), "distance": pa.array(distance)}

    rows = integer_rows(table, scale, dim, placed, "cell int, distance double")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "cells")
    asked = integer_rows(queries, scale, dim, placed, "cell int, distance double")
    asked = written(asked.withColumn("row", F.monotonically_increasing_id()), "query_cells")  # freezes the ids
    cut, query_cut = Cut(rows, len(cells), block_rows), Cut(asked, len(cells), group_rows)
    if not query_cut.rows.any():
        return none
    radii = np.zeros(len(cells))
    for cell, radius in rows.groupBy("cell").agg(F.max("distance")).collect():  # one row per cell
        radii[cell] = radius
    centres, norms = top.centres[cells], top.norms[cells]
    usable = np.flatnonzero(cut.rows)
    rows = cut.number(rows, "row", "block").select("block", "vec_id", "vector")
    starters = usable[cut.rows[usable] > k] if (cut.rows > k).any() else usable

    def gather(key: tuple, part: pa.Table) -> pa.Table:
        """A group of queries as one row, with the block that it visits first."""
        group, vectors = key[0].as_py(), matrix(part["vector"])
        centre = vectors.mean(axis=0)
        radius = lengths(vectors - centre).max()
        most = _bounds(centre, lengths(centre[None])[0], radius, centres[starters], norms[starters], radii[starters])
        blocks = cut.of(starters[most.argmax()])
        data = packed(part.select(["row", "vec_id", "vector"]))
        return pa.table({"group": pa.array([group], pa.int32()), "packed": pa.array([data], pa.binary()),
                         "block": pa.array([blocks[group % len(blocks)]], pa.int32())})

    groups = query_cut.number(asked, "row", "group").groupBy("group")
    groups = written(groups.applyInArrow(gather, "group int, packed binary, block int"), "query_groups")

    def first_visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        """What a group finds in its first block, the k-th scores, and the cells it has to visit."""
        out = []
        tree = RowTree(block)
        for group, data, seen in zip(*(visitors[c].to_pylist() for c in ("group", "packed", "block")), strict=True):
            query = unpacked(data)
            q = matrix(query["vector"])
            best = Best(len(q), k)
            search(q, query["vec_id"].to_numpy(), tree, best)
            query = query.append_column("needed", pa.array(best.needed))
            wanted = np.zeros(len(usable), dtype=bool)
            own = CoverTree(q, QUERY_LEAF)
            for a in own.leaves():
                bound = _bounds(own.centres[a], own.norms[a], own.radii[a], centres[usable], norms[usable], radii[usable])
                wanted |= ~(bound < best.needed[own.order[own.low[a] : own.high[a]]].min())
            out.append((group, seen, packed(query), usable[wanted].tolist(), _answer(query, best)))
        return _table(out, first_schema)

    def visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        out = []
        tree = RowTree(block)
        for data in visitors["packed"].to_pylist():
            query = unpacked(data)
            q = matrix(query["vector"])
            best = Best(len(q), k, query["needed"].to_numpy())
            search(q, query["vec_id"].to_numpy(), tree, best)
            out.append((_answer(query, best),))
        return _table(out, pa.schema([first_schema.field("found")]))

    first = written(met(groups.select("group", "block"), groups.drop("block"), rows, first_visit,
                        f"group int, seen int, packed binary, visit array<int>, {FOUND}"), "first_visits")
    pieces = [(int(c), int(cut.first[c]), int(cut.first[c] + cut.pieces[c]) - 1) for c in usable]
    pieces = F.broadcast(spark.createDataFrame(pieces, "cell int, low int, high int"))  # one row per cell
    visits = first.select("group", "seen", F.explode("visit").alias("cell")).join(pieces, "cell")
    visits = visits.select("group", "seen", F.explode(F.sequence("low", "high")).alias("block"))
    visits = visits.where("block != seen").select("group", "block")
    rest = met(visits, first.select("group", "packed"), rows, visit, FOUND)
    found = first.select("found").unionByName(rest).select(F.inline("found"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


_RESULT = pa.struct([("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
first_schema = pa.schema(
    [("group", pa.int32()), ("seen", pa.int32()), ("packed", pa.binary()), ("visit", pa.list_(pa.int32())),
     ("found", pa.list_(_RESULT))]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)], schema=schema)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::bigint AS score
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::int AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
