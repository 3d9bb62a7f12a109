"""Which shard a document belongs to, and the order of rows in shards and files.

Rows in order are laid out by bytes: the place of a row is the number of bytes before it in the whole
order, and a file holds a range of places of one size. Places follow from a small table with the size of
every member (a document or word), so the rows themselves are neither sampled nor read twice: each looks
up its part where it is and is sent there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ..functions.text import shard_of_name
from ..workspace import ship_package, written

MOST_BYTES, LEAST_BYTES = 128 << 20, 1 << 20  # of a part; between them as many parts as there are cores


def add_shard(df: DataFrame, shards: int, doc: str = "doc") -> DataFrame:
    """Add ``shard INT``: all lines of a document go to the same shard."""
    return df.withColumn("shard", shard_of_name(F.col(doc), shards))


class Parts:
    """The parts of an order, from ``sizes`` (``group, member, size, last``, one row per member).

    Members are ordered by group and member, the latter descending if asked for. The driver gets only
    the members with which a part begins and those that reach into a further part: as many as there are
    parts, twice at most, and one for each chunk of ``sizes``. A member larger than a part is cut by the
    position of its rows, which runs from 0 to ``last``, as if its bytes were spread evenly over them.
    """

    def __init__(self, sizes: DataFrame, descending: bool = False, part_bytes: int | None = None):
        ship_package(sizes.sparkSession)
        order = F.desc("member") if descending else F.asc("member")
        size = F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size")
        chunks = sizes.repartitionByRange("group", order).select(
            "group", "member", size, F.col("last").cast("bigint").alias("last"), F.spark_partition_id().alias("chunk")
        )
        chunks = written(chunks, "layout_chunks")
        starts, total = {}, 0  # one entry per chunk
        for chunk, n in chunks.groupBy("chunk").agg(F.sum("size")).orderBy("chunk").collect():
            starts[chunk] = total
            total += n
        if not part_bytes:
            cores = sizes.sparkSession.sparkContext.defaultParallelism
            part_bytes = min(MOST_BYTES, max(LEAST_BYTES, total // cores + 1))
        self.bytes, self.count, self.descending = part_bytes, max(0, total - 1) // part_bytes + 1, descending
        direction = "descending" if descending else "ascending"

        def find(key: tuple, table: pa.Table) -> pa.Table:
            table = table.sort_by([("group", "ascending"), ("member", direction)])
            size = table["size"].to_numpy()
            ends = starts[key[0].as_py()] + np.cumsum(size)
            start = ends - size
            part = start // part_bytes
            begins = np.diff(part, prepend=-1) != 0
            begins[:1] = True
            at = np.flatnonzero(begins | (np.maximum(ends - 1, start) // part_bytes != part))
            found = table.take(pa.array(at)).append_column("row", pa.array(at))
            return found.append_column("start", pa.array(start[at]))

        fields = {f.name: f.dataType.simpleString() for f in chunks.schema} | {"row": "bigint", "start": "bigint"}
        schema = ", ".join(f"`{name}` {kind}" for name, kind in fields.items())
        bounds = chunks.groupBy("chunk").applyInArrow(find, schema).orderBy("chunk", "row").toArrow()
        self.groups, self.members = (_values(bounds[name]) for name in ("group", "member"))
        self.start, self.size = bounds["start"].to_numpy(), bounds["size"].to_numpy()
        self.last = pc.fill_null(bounds["last"], -1).to_numpy()

    def find(self, groups: np.ndarray, members: np.ndarray) -> np.ndarray:
        """For distinct keys the last entry at or before them in the order."""
        at = np.zeros(len(groups), dtype=np.int64)
        for group in np.unique(groups):
            mine = groups == group
            low, high = np.searchsorted(self.groups, group), np.searchsorted(self.groups, group, side="right")
            known = self.members[low:high]
            if self.descending:
                at[mine] = high - np.searchsorted(known[::-1], members[mine]) - 1
            else:
                at[mine] = low + np.searchsorted(known, members[mine], side="right") - 1
        return np.maximum(at, 0)

    def numbers(self, groups: np.ndarray, members: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """The part of each row."""
        if not len(self.start):
            return np.zeros(len(groups), dtype=np.int32)
        _, distinct = np.unique(members, return_inverse=True)
        keys, first, inverse = np.unique(
            groups.astype(np.int64) * (len(distinct) + 1) + distinct, return_index=True, return_inverse=True
        )
        at = self.find(groups[first], members[first])
        itself = (self.groups[at] == groups[first]) & (self.members[at] == members[first])
        at, itself = at[inverse], itself[inverse]
        # what follows an entry goes where that ends, and a member without positions where it begins
        cut = self.last[at] >= 0
        share = np.where(itself & cut, np.clip(positions / np.maximum(self.last[at] + 1.0, 1.0), 0.0, 1.0), ~itself)
        inside = np.minimum(self.size[at] * share, self.size[at] - 1.0)
        return ((self.start[at] + np.maximum(inside, 0.0).astype(np.int64)) // self.bytes).astype(np.int32)


def _values(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Numbers, or texts as objects; a null comes before all others."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_integer(column.type):
        return pc.fill_null(column.cast(pa.int64()), np.iinfo(np.int64).min).to_numpy()
    return pc.fill_null(column.cast(pa.string()), "").to_numpy(zero_copy_only=False)


def in_order(
    rows: DataFrame,
    sizes: DataFrame,
    member: str,
    group: str | None = None,
    position: str | None = None,
    descending: bool = False,
    part_bytes: int | None = None,
) -> DataFrame:
    """Sort by ``group``, ``member`` and ``position`` over all files, which in name order hold ranges of
    the order of about equal bytes.

    ``sizes`` has the key columns, ``size`` and, if members may be cut, ``last``, the greatest
    position. The order is exact whatever the sizes say; they decide only how even the files are.
    """
    group_of = F.col(group) if group else F.lit(0)
    last = F.col("last") if "last" in sizes.columns else F.lit(None).cast("bigint")
    keyed = sizes.select(group_of.cast("bigint").alias("group"), F.col(member).alias("member"), "size", last.alias("last"))
    parts = Parts(keyed, descending, part_bytes)
    held = rows.sparkSession.sparkContext.broadcast(parts)

    @F.arrow_udf(IntegerType())
    def part(groups: pa.Array, members: pa.Array, positions: pa.Array) -> pa.Array:
        return pa.array(held.value.numbers(_values(groups), _values(members), _values(positions)))

    at = _place(rows, position) if position else F.lit(0).cast("bigint")
    order = [*([group] if group else []), F.desc(member) if descending else F.asc(member), *([position] if position else [])]
    number = part(group_of.cast("bigint"), F.col(member), at)
    return rows.repartitionById(parts.count, number).sortWithinPartitions(*order)


def _place(rows: DataFrame, position: str) -> Column:
    """A position as a number: unnumbered lines of a file have that of their file split."""
    if isinstance(rows.schema[position].dataType, StructType):
        return F.col(position)["_block"].cast("bigint")
    return F.col(position).cast("bigint")


def line_sizes(lines: DataFrame, size: Column, member: str = "doc") -> DataFrame:
    """The ``sizes`` of the documents of ``lines``; reads the columns in ``size`` and the keys."""
    return lines.groupBy("shard", member).agg(
        F.sum(size).cast("bigint").alias("size"), F.max(_place(lines, "line_no")).alias("last")
    )


def lines_in_order(lines: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Lines by shard, document name and line number. Without ``sizes``, lines with an ``n_ids`` count by
    it, and others alike."""
    if sizes is None:
        sizes = line_sizes(lines, F.col("n_ids") if "n_ids" in lines.columns else F.lit(1))
        sizes = sizes.withColumn("size", F.col("size") * 8)  # bytes of an id and its blank, on average
    return in_order(lines, sizes, "doc", "shard", "line_no")


def words_in_order(words: DataFrame, row_bytes: int = 64, constant: str | None = None) -> DataFrame:
    """Rows by the bytes of their word, and rows of one word in their given order. The row id makes
    the key unique, so that also one word's rows can be cut into ranges. Rows are also known to be
    sorted by ``constant``, a column with one value, which then can name a directory."""
    rows = words.withColumn("_row", F.monotonically_increasing_id())
    sizes = rows.groupBy("word").agg((F.count(F.lit(1)) * row_bytes).alias("size"), F.max("_row").alias("last"))
    ordered = in_order(rows, sizes, "word", position="_row")
    if constant:
        ordered = ordered.sortWithinPartitions(constant, "word", "_row")
    return ordered.drop("_row")
