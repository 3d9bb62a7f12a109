"""Integer vectors: scaling, exact inner products, and blocks of rows that meet groups of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches

EXACT = 2.0**53  # products of vectors whose lengths multiply to less are exact in doubles
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def list_column(rows: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), max(1, rows.shape[1])).cast(pa.list_(pa.float64()))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column whose lists have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _scaled(column: pa.Array, scale: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that take part, as floor(scale * x), and their row numbers."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
    with np.errstate(all="ignore"):
        values = np.floor(values * scale)
    row = np.repeat(np.arange(len(sizes)), sizes)
    position = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = np.zeros((len(sizes), dim))
    rows[row, position] = values
    taken = np.isfinite(rows).all(axis=1) & column.is_valid().to_numpy(zero_copy_only=False)
    return rows[taken], np.flatnonzero(taken)


def longest(*tables: DataFrame, vector: str = "embedding") -> tuple[int, int]:
    """The length of the longest vector, and the number of rows of the last table."""
    found = [t.agg(F.max(F.size(vector)), F.count(F.lit(1))).first() for t in tables]
    return max([1, *(size or 0 for size, _ in found)]), found[-1][1]


def integer_rows(
    rows: DataFrame,
    scale: int,
    dim: int,
    derive: Callable[[np.ndarray], dict[str, pa.Array]] = lambda vectors: {},
    derived: str = "",
    vector: str = "embedding",
) -> DataFrame:
    """The other columns of ``rows``, the ``vector`` times ``scale`` rounded down, and the columns
    ``derived`` that ``derive`` gives for a batch of vectors.

    Vectors that are null or have a null or non-finite component, also after scaling, are left out.
    Components are integers held as doubles; shorter vectors are filled up with zeros.
    """
    others = rows.drop(vector)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema)
    source = rows.select(*others.columns, F.col(vector).cast("array<double>").alias("vector"))

    def convert(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors, taken = _scaled(batch.column("vector"), scale, dim)
        if len(vectors):
            kept = batch.drop_columns("vector").take(pa.array(taken))
            extra = derive(vectors)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, list_column(vectors), *extra.values()], [*kept.schema.names, "vector", *extra]
            )

    return map_batches(source, convert, ", ".join(filter(None, (fields, "vector array<double>", derived))))


def lengths(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def products(a: np.ndarray, b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray) -> np.ndarray:
    """All inner products, exactly; one beyond the range of a long counts as the end of that range."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    with np.errstate(all="ignore"):
        if a_lengths.max() * b_lengths.max() < EXACT:
            return (a @ b.T).astype(np.int64)
        safe = a_lengths[:, None] * b_lengths[None, :] < EXACT
        found = np.where(safe, a @ b.T, 0.0).astype(np.int64)
    for i, j in np.argwhere(~safe):
        exact = sum(int(x) * int(y) for x, y in zip(a[i], b[j], strict=True))
        found[i, j] = min(max(exact, LEAST), MOST)
    return found


class Best:
    """The ``k`` best candidates of each of some queries: higher scores first, then smaller ids.

    ``floor`` is the score that a query needs anyway, from what was found elsewhere."""

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((queries, k), LEAST, dtype=np.int64)
        self.ids = np.full((queries, k), MOST, dtype=np.int64)
        self.found = np.zeros(queries, dtype=np.int64)
        self.needed = np.full(queries, LEAST, dtype=np.int64) if floor is None else floor.copy()

    def offer(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = self.found[query]
        scores, ids = np.append(self.scores[query, :n], scores), np.append(self.ids[query, :n], ids)
        order = np.lexsort((ids, ~scores))[: self.k]  # ~ turns the order round without overflow
        n = len(order)
        self.scores[query, :n], self.ids[query, :n] = scores[order], ids[order]
        self.found[query] = n
        if n == self.k:
            self.needed[query] = max(self.needed[query], self.scores[query, -1])

    def offer_all(self, first: int, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Candidates ``ids`` with ``scores`` for the queries from ``first`` on."""
        hits = allowed & (scores >= self.needed[first : first + len(scores), None])
        for i in np.flatnonzero(hits.any(axis=1)):
            at = np.flatnonzero(hits[i])
            self.offer(first + i, scores[i, at], ids[at])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, id and score of all that was found."""
        query, place = np.nonzero(np.arange(self.k)[None, :] < self.found[:, None])
        return query, self.ids[query, place], self.scores[query, place]


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


class Cut:
    """Cells of rows cut into numbered pieces of about ``size`` rows: cell ``c`` has those from ``first[c]`` on."""

    def __init__(self, cells: DataFrame, n_cells: int, size: int):
        self.rows = np.zeros(n_cells, dtype=np.int64)
        for cell, n in cells.groupBy("cell").count().collect():  # one row per cell
            self.rows[cell] = n
        self.pieces = -(-self.rows // size)
        self.first = np.cumsum(self.pieces) - self.pieces

    def of(self, cell: int) -> range:
        return range(self.first[cell], self.first[cell] + self.pieces[cell])

    def number(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with the number of their piece: the cell's first and a hash of ``key``."""
        cells = [(c, int(f), int(n)) for c, (f, n) in enumerate(zip(self.first, self.pieces, strict=True)) if n]
        table = rows.sparkSession.createDataFrame(cells, "cell int, _first int, _pieces int")
        piece = F.col("_first") + F.pmod(F.xxhash64(key), "_pieces")
        return rows.join(F.broadcast(table), "cell").withColumn(name, piece.cast("int")).drop("_first", "_pieces")


GROUPS_PER_TASK = 32


def met(
    visits: DataFrame, groups: DataFrame, rows: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``function`` of the rows of every block, and of at most ``GROUPS_PER_TASK`` of the groups that visit it.

    ``visits`` has ``group, block``, ``groups`` has ``group`` and what belongs to it, ``rows`` has ``block``.
    Where more groups visit a block, it is copied for each lot of them.
    """
    visits = visits.withColumn("lot", F.floor(F.col("group") / GROUPS_PER_TASK).cast("int"))
    wanted = visits.select(F.col("block").alias("to_block"), F.col("lot").alias("to_lot")).distinct()
    left = rows.join(wanted, F.col("block") == F.col("to_block")).drop("block")
    right = visits.join(groups, "group")
    return left.groupBy("to_block", "to_lot").cogroup(right.groupBy("block", "lot")).applyInArrow(function, schema)
