"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions and its length. By the triangle inequality
on the sphere the angle between two vectors with the angles a and b to a reference lies between |a - b|
and the smaller of a + b and 2 pi - a - b. The references together give an interval of the cosine;
times both lengths, and rounded outwards by more than the arithmetic can be off, it bounds the integer
inner product. Only rows whose interval overlaps a window of scores that still counts are scored, on
the integers and exactly. For positives the window begins at the score of the last one needed; for
negatives it is a share of the score of the positive.

The same bounds hold for whole cells (rows with the same nearest reference and a like angle to it) with
the least and greatest angles and lengths in them. Cells are cut into blocks of bounded size, anchors
into groups, and a group visits only blocks of cells that overlap a window of one of its anchors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textvec.llm.int_vectors import (
    LEAST,
    MOST,
    Best,
    Cut,
    integer_rows,
    lengths,
    list_column,
    longest,
    matrix,
    met,
    packed,
    products,
    unpacked,
)
from textvec.workspace import written

REFERENCES = 16
SAMPLE = 2048  # rows that the reference directions are chosen from
MAX_BANDS = 64  # bands of the angle to the nearest reference
BLOCK_ROWS, GROUP_ROWS = 16_384, 512
TILE = 1 << 20  # pairs whose intervals are held at a time
MARGIN = 1e-6  # above the rounding error of arccos next to 1


def references(sample: np.ndarray) -> np.ndarray:
    """Unit vectors far apart: each the row with the greatest angle to the nearest one chosen before."""
    size = lengths(sample)
    sample = sample[(size > 0) & np.isfinite(size)]
    if not len(sample):
        return np.eye(1)
    units = sample / lengths(sample)[:, None]
    chosen, nearest = [units[0]], units @ units[0]
    while len(chosen) < REFERENCES and nearest.min() < 1 - 1e-9:
        chosen.append(units[nearest.argmin()])
        nearest = np.maximum(nearest, units @ chosen[-1])
    return np.array(chosen)


def angles_to(directions: np.ndarray, vectors: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Angles in 0 to pi; a zero vector, whose products are 0 at any angle, has right angles."""
    with np.errstate(all="ignore"):
        cosine = (vectors[:, : directions.shape[1]] @ directions.T) / size[:, None]
    cosine[size == 0] = 0.0
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def score_intervals(
    anchor_angles: np.ndarray, anchor_lengths: np.ndarray, low: np.ndarray, high: np.ndarray, shortest: np.ndarray, longest_: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each anchor with vectors whose angles lie between ``low`` and
    ``high`` and whose lengths lie between ``shortest`` and ``longest_``; NaN where there is no bound."""
    near = np.zeros((len(anchor_angles), len(low)))
    far = np.full(near.shape, np.pi)
    for a, b, c in zip(anchor_angles.T[:, :, None], low.T[:, None], high.T[:, None], strict=True):
        np.maximum(near, b - a, out=near)
        np.maximum(near, a - c, out=near)
        np.minimum(far, a + c, out=far)
        np.minimum(far, 2 * np.pi - a - b, out=far)
    most, least = np.cos(np.maximum(near - MARGIN, 0.0)), np.cos(np.minimum(far + MARGIN, np.pi))
    with np.errstate(all="ignore"):
        size = anchor_lengths[:, None]
        slack = 1e-9 * size * longest_ + 1e-6
        greatest = size * most * np.where(most >= 0, longest_, shortest) + slack
        return size * least * np.where(least >= 0, shortest, longest_) - slack, greatest


class _Group:
    """Anchors of one group, or the rows of a block."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
        self.vectors, self.angles = matrix(table["vector"]), matrix(table["angles"])
        self.lengths = table["length"].to_numpy()

    def __len__(self) -> int:
        return len(self.ids)

    def intervals(self, mine: slice, rows: _Group, part: slice) -> tuple[np.ndarray, np.ndarray]:
        angles, size = rows.angles[part], rows.lengths[part]
        return score_intervals(self.angles[mine], self.lengths[mine], angles, angles, size, size)

    def scores(self, mine: slice, rows: _Group, at: np.ndarray) -> np.ndarray:
        return products(self.vectors[mine], rows.vectors[at], self.lengths[mine], rows.lengths[at])


def _tiles(anchors: int, rows: int):
    step = max(1, min(64, anchors))
    for a in range(0, anchors, step):
        for b in range(0, rows, TILE // step):
            yield slice(a, min(a + step, anchors)), slice(b, min(b + TILE // step, rows))


def _positives(anchors: _Group, rows: _Group, best: Best) -> None:
    """Offer the rows of an anchor's label that its window, from the last score needed on, overlaps."""
    for mine, part in _tiles(len(anchors), len(rows)):
        _, greatest = anchors.intervals(mine, rows, part)
        overlaps = ~(greatest < best.needed[mine, None])
        overlaps &= anchors.labels[mine, None] == rows.labels[None, part]
        overlaps &= anchors.ids[mine, None] != rows.ids[None, part]
        at = np.flatnonzero(overlaps.any(axis=0))
        if len(at):
            scores = anchors.scores(mine, rows, at + part.start)
            best.offer_all(mine.start, scores, rows.ids[at + part.start], overlaps[:, at])


def _negatives(anchors: _Group, rows: _Group, of: np.ndarray, low: np.ndarray, high: np.ndarray, best: Best) -> None:
    """Offer rows of other labels with scores in the windows ``low`` to ``high`` of the anchors ``of``,
    which ascend."""
    for mine, part in _tiles(len(anchors), len(rows)):
        windows = np.arange(*np.searchsorted(of, [mine.start, mine.stop]))
        if not len(windows):
            continue
        least, greatest = anchors.intervals(mine, rows, part)
        other = anchors.labels[mine, None] != rows.labels[None, part]
        from_ = np.maximum(low[windows], best.needed[windows])
        wanted = np.zeros(len(rows.ids[part]), dtype=bool)
        for i, begin, end in zip(of[windows] - mine.start, from_, high[windows], strict=True):
            wanted |= other[i] & ~(greatest[i] < begin) & ~(least[i] > end)
        at = np.flatnonzero(wanted)
        if not len(at):
            continue
        scores, ids = anchors.scores(mine, rows, at + part.start), rows.ids[at + part.start]
        for w, i, begin, end in zip(windows, of[windows] - mine.start, from_, high[windows], strict=True):
            hits = np.flatnonzero((scores[i] >= begin) & (scores[i] <= end) & other[i, at])
            if len(hits):
                best.offer(w, scores[i, hits], ids[hits])


def score_windows(scores: list[int], low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer between ``low`` and ``high`` percent of each score."""
    clipped = [(max(-(-low * s // 100), LEAST), min(high * s // 100, MOST)) for s in scores]
    return (np.array([w[i] for w in clipped], dtype=np.int64) for i in range(2))


def hard_negatives(
    anchors: DataFrame,
    table: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of the vectors floor(``scale`` * x); higher scores come first, ties by
    smaller ``vec_id``. The positives of an anchor are the first ``positives`` rows of its label with
    another id, the negatives of each the first ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` percent of the positive's. A positive with a negative score has none.

    Both tables have ``vec_id``, ``embedding`` and an integer ``label``; further columns are ignored. Rows
    with a null id or label take no part, nor do vectors that are null, have a null or non-finite
    component, or overflow when scaled. Shorter vectors count as filled up with zeros. Repeated rows
    count one by one, as anchors, positives and negatives. Scores are exact; one beyond the range of a
    long counts as the end of that range. Empty tables give no rows.
    """
    spark = table.sparkSession
    anchors, table = (
        t.where("vec_id is not null and label is not null").selectExpr(
            "cast(vec_id as bigint) vec_id", "cast(label as bigint) label", "embedding"
        )
        for t in (anchors, table)
    )
    result = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    dim, n_rows = longest(anchors, table)
    plain = integer_rows(table, scale, dim)
    chosen = plain.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE).select("vector").toArrow()
    if not len(chosen):
        return spark.createDataFrame([], result)
    directions = references(matrix(chosen["vector"]))
    bands = max(1, min(MAX_BANDS, -(-2 * n_rows // (block_rows * len(directions)))))
    n_cells = bands * len(directions)

    def placed(vectors: np.ndarray) -> dict[str, pa.Array]:
        size = lengths(vectors)
        angles = angles_to(directions, vectors, size)
        nearest = np.nan_to_num(angles, nan=4.0).argmin(axis=1)
        angle = np.nan_to_num(angles[np.arange(len(angles)), nearest])
        band = np.minimum(angle * bands / np.pi, bands - 1).astype(np.int32)
        cell = pa.array((nearest * bands + band).astype(np.int32))
        return {"cell": cell, "angles": list_column(angles), "length": pa.array(size)}

    derived = "cell int, angles array<double>, length double"
    rows = integer_rows(table, scale, dim, placed, derived)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "cells")
    asked = integer_rows(anchors, scale, dim, placed, derived)
    asked = written(asked.withColumn("row", F.monotonically_increasing_id()), "anchor_cells")  # freezes the ids
    cut, asked_cut = Cut(rows, n_cells, block_rows), Cut(asked, n_cells, group_rows)
    if not asked_cut.rows.any():
        return spark.createDataFrame([], result)

    # per cell the least and greatest angles and lengths, and which of 64 classes of labels it has
    usable = np.flatnonzero(cut.rows)
    angle = [F.col("angles")[j] for j in range(len(directions))]
    label_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("label", F.lit(64)).cast("int"))
    summary = rows.groupBy("cell").agg(
        F.array(*map(F.min, angle)), F.array(*map(F.max, angle)), F.min("length"), F.max("length"), F.bit_or(label_bit)
    )
    summary = sorted(summary.collect())  # one row per cell
    least, greatest, shortest, longest_ = (np.array([row[i] for row in summary], dtype=float) for i in range(1, 5))
    classes = np.array([row[5] for row in summary], dtype=np.int64)
    rows = cut.number(rows, "row", "block").select("block", "vec_id", "label", "vector", "angles", "length")
    largest = int(cut.rows.argmax())
    columns = ["row", "vec_id", "label", "vector", "angles", "length"]

    def gather(key: tuple, part: pa.Table) -> pa.Table:
        """A group of anchors as one row, with the block of its own cell that it visits first."""
        cell = part["cell"][0].as_py()
        group, blocks = key[0].as_py(), cut.of(cell if cut.rows[cell] else largest)
        return _table([(group, blocks[group % len(blocks)], packed(part.select(columns)))], _GROUPS)

    groups = asked_cut.number(asked, "row", "group").groupBy("group")
    groups = written(groups.applyInArrow(gather, "group int, block int, packed binary"), "anchor_groups")

    def found_positives(group: int, query: pa.Table, best: Best) -> list[dict]:
        at, ids, scores = best.rows()
        return _structs(_POSITIVE, [group] * len(at), query["row"].to_numpy()[at].tolist(), ids.tolist(), scores.tolist())

    def first_visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        out, rows_ = [], _Group(block)
        for group, seen, data in zip(*(visitors[c].to_pylist() for c in ("group", "block", "packed")), strict=True):
            query = unpacked(data)
            mine, best = _Group(query), Best(len(query), positives)
            _positives(mine, rows_, best)
            _, bound = score_intervals(mine.angles, mine.lengths, least, greatest, shortest, longest_)
            wanted = ~(bound < best.needed[:, None])
            wanted &= (classes[None, :] >> (mine.labels[:, None] % 64)) & 1 == 1
            query = query.append_column("needed", pa.array(best.needed))
            cells = usable[wanted.any(axis=0)].tolist()
            out.append((group, seen, packed(query), cells, found_positives(group, query, best)))
        return _table(out, _FIRST)

    def next_visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        out, rows_ = [], _Group(block)
        for group, data in zip(*(visitors[c].to_pylist() for c in ("group", "packed")), strict=True):
            query = unpacked(data)
            best = Best(len(query), positives, query["needed"].to_numpy())
            _positives(_Group(query), rows_, best)
            out.append((found_positives(group, query, best),))
        return _table(out, pa.schema([_FIRST.field("found")]))

    first = met(groups.select("group", "block"), groups.drop("block"), rows, first_visit, _sql(_FIRST))
    first = written(first, "first_visits")
    pieces = [(int(c), int(cut.first[c]), int(cut.first[c] + cut.pieces[c]) - 1) for c in usable]
    pieces = F.broadcast(spark.createDataFrame(pieces, "cell int, low int, high int"))  # one row per cell

    def blocks_of(visitors: DataFrame, *kept: str) -> DataFrame:
        cells = visitors.select("group", *kept, F.explode("visit").alias("cell")).join(pieces, "cell")
        return cells.select("group", *kept, F.explode(F.sequence("low", "high")).alias("block"))

    visits = blocks_of(first, "seen").where("block != seen").select("group", "block")
    rest = met(visits, first.select("group", "packed"), rows, next_visit, f"found {_sql(_FIRST).split('found ')[1]}")
    found = first.select("found").unionByName(rest).select(F.inline("found"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    found = found.withColumn("number", rank).where(F.col("number") <= positives)

    def with_windows(group: pa.Table, found: pa.Table) -> pa.Table:
        """The group with the windows of its positives, and the cells that one of them overlaps."""
        if not len(group) or not len(found):
            return _table([], _WINDOWED)
        query = unpacked(group["packed"][0].as_py())
        mine, place = _Group(query), {row: i for i, row in enumerate(query["row"].to_pylist())}
        of = np.array([place[row] for row in found["row"].to_pylist()])
        order = np.argsort(of, kind="stable")
        found, of = found.take(pa.array(order)), of[order]
        begin, end = score_windows(found["score"].to_pylist(), low, high)
        at = np.flatnonzero(begin <= end)
        least_, greatest_ = score_intervals(mine.angles, mine.lengths, least, greatest, shortest, longest_)
        wanted = np.zeros(len(usable), dtype=bool)
        for i, b, e in zip(of[at], begin[at], end[at], strict=True):
            wanted |= ~(greatest_[i] < b) & ~(least_[i] > e)
        windows = found.select(["number", "vec_id", "score"]).take(pa.array(at))
        for name, values in (("of", of), ("begin", begin), ("end", end)):
            windows = windows.append_column(name, pa.array(values[at]))
        return _table([(group["group"][0].as_py(), packed(query), packed(windows), usable[wanted].tolist())], _WINDOWED)

    windowed = first.select("group", "packed").groupBy("group").cogroup(found.groupBy("group"))
    windowed = written(windowed.applyInArrow(with_windows, _sql(_WINDOWED)), "windows")

    def last_visit(block: pa.Table, visitors: pa.Table) -> pa.Table:
        out, rows_ = [], _Group(block)
        for data, more in zip(*(visitors[c].to_pylist() for c in ("packed", "windows")), strict=True):
            query, windows = unpacked(data), unpacked(more)
            of, begin, end = (windows[c].to_numpy() for c in ("of", "begin", "end"))
            best = Best(len(windows), negatives, begin)
            _negatives(_Group(query), rows_, of, begin, end, best)
            at, ids, scores = best.rows()
            anchor, window = query.take(pa.array(of[at])), windows.take(pa.array(at))
            out.append(pa.table(
                [anchor["row"], anchor["vec_id"], window["number"], window["vec_id"], window["score"], pa.array(ids), pa.array(scores)],
                schema=_NEGATIVES,
            ))
        return pa.concat_tables(out)

    last = met(blocks_of(windowed), windowed.select("group", "packed", "windows"), rows, last_visit, _sql(_NEGATIVES))
    order = Window.partitionBy("row", "number").orderBy(F.desc("negative_score"), "negative_id")
    last = last.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return last.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


_POSITIVE = pa.struct([("group", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_GROUPS = pa.schema([("group", pa.int32()), ("block", pa.int32()), ("packed", pa.binary())])
_FIRST = pa.schema(
    [("group", pa.int32()), ("seen", pa.int32()), ("packed", pa.binary()), ("visit", pa.list_(pa.int32())), ("found", pa.list_(_POSITIVE))]
)
_WINDOWED = pa.schema(
    [("group", pa.int32()), ("packed", pa.binary()), ("windows", pa.binary()), ("visit", pa.list_(pa.int32()))]
)
_NEGATIVES = pa.schema(
    [("row", pa.int64()), ("anchor_id", pa.int64()), ("number", pa.int32()), ("positive_id", pa.int64()),
     ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())]
)
_NAMES = {pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary"}


def _type(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{f.name}: {_type(f.type)}' for f in kind)}>"
    return _NAMES[kind]


def _sql(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {_type(field.type)}" for field in schema)


def _structs(kind: pa.StructType, *columns: list) -> list[dict]:
    return [dict(zip((f.name for f in kind), row, strict=True)) for row in zip(*columns, strict=True)]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([row[i] for row in rows], field.type) for i, field in enumerate(schema)], schema=schema)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::double)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, list_dot_product(a.e, v.e)::bigint AS score
  FROM v a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, (row_number() OVER (
    PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::int AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
