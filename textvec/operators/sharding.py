"""Greedy packing of documents into shards of similar byte size.

The rules, for documents in ascending order of their key and ``limit = total bytes div n``: a
document above the limit is a shard of its own. The others fill an open group; as soon as the group
exceeds the limit it is closed, so a group passes the limit by at most one member. Shards are
numbered in the order in which they close, the group left open at the end being the last.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..workspace import ship_package, written


def _limit(n_shards: int, size: str) -> Column:
    if n_shards < 1:
        raise ValueError("the number of shards must be positive")
    return F.expr(f"coalesce(sum(`{size}`), 0) div {n_shards}").alias("shard_limit")


def shard_limit(documents: DataFrame, n_shards: int, size: str = "size") -> DataFrame:
    """One row ``shard_limit BIGINT``: the byte size above which a shard is closed."""
    return documents.agg(_limit(n_shards, size))


def _closers(ends: np.ndarray, limit: int, base: int) -> np.ndarray:
    """Row numbers that close a group, for rows that end at the bytes ``ends``, when the open group
    began after ``base`` bytes."""
    found = []
    while (row := int(np.searchsorted(ends, base + limit, side="right"))) < len(ends):
        found.append(row)
        base = int(ends[row])
    return np.array(found, dtype=np.int64)


def _bands(ends: list[int], largest: list[int], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (low, high] of bytes that hold the ends of all groups, for chunks that end at ``ends``.

    The k-th group ends one limit after the one before, and at most one document later; how large that
    is its chunk tells. Once intervals meet, all that follows counts."""
    lows, highs, low, high = [], [], 0, 0
    while (first := bisect_right(ends, low + limit)) < len(ends):
        last = min(bisect_right(ends, high + limit), len(ends) - 1)
        low, before = low + limit, high
        high += limit + max(largest[first : last + 1])
        if low < before:
            low, high = before, ends[-1]
        lows.append(low)
        highs.append(high)
        if high >= ends[-1]:
            break
    return np.array(lows, dtype=np.int64), np.array(highs, dtype=np.int64)


def _exits(
    chunks: DataFrame, order: str, limit: int, starts: dict[int, int], ends: list[int], bands: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """For every row that could be a chunk's first closing one (``entry``), the chunk's last closing
    one (``exit``), both as the bytes up to and including the row, and the chunk in which the next
    group closes (``onward``, null for none). Only rows inside the bands can close a group."""
    numbers = np.array(list(starts))

    def follow(key: tuple, table: pa.Table) -> pa.Table:
        start = starts[key[0].as_py()]
        own = start + np.cumsum(table.sort_by(order)["packed"].to_numpy())
        # a group open at the start has begun at or before it
        entries = np.unique(own[: np.searchsorted(own, start + limit, side="right") + 1])
        band = np.searchsorted(bands[1], entries)
        inside = band < len(bands[1])
        inside[inside] = bands[0][band[inside]] < entries[inside]
        entries = entries[inside]
        after = np.append(np.searchsorted(own, own + limit, side="right"), len(own))
        last = np.searchsorted(own, entries)
        while (moving := after[last] < len(own)).any():
            last = np.where(moving, after[last], last)
        onward = np.searchsorted(ends, own[last] + limit, side="right")
        found = onward < len(ends)
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(entries), pa.int32()),
            "entry": entries,
            "exit": own[last],
            "onward": pa.array(numbers[np.where(found, onward, 0)].astype(np.int32), mask=~found),
        })

    return chunks.groupBy("chunk").applyInArrow(follow, "chunk int, entry bigint, exit bigint, onward int")


def _next_entries(exits: DataFrame, limit: int) -> DataFrame:
    """``entry, next``: the row that closes the first group of a later chunk after the groups that
    begin to close with ``entry`` in its chunk."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        entries = np.sort(right["entry"].to_numpy())
        at = np.searchsorted(entries, left["exit"].to_numpy() + limit, side="right")
        # an entry that the bands let pass, but nothing leads to, may lead nowhere
        found = at < len(entries)
        return pa.table({"entry": left["entry"].filter(pa.array(found)), "next": entries[at[found]]})

    leaving = exits.where("onward is not null").select("onward", "entry", "exit")
    arriving = exits.select(F.col("chunk").alias("to"), F.col("entry"))
    return leaving.groupBy("onward").cogroup(arriving.groupBy("to")).applyInArrow(look, "entry bigint, next bigint")


def _reached(jumps: DataFrame, first: int, steps: int) -> list[int]:
    """The entries that follow each other from ``first`` on, at most one for each chunk.

    By pointer jumping: in every round the known beginning of the path doubles, as do the jumps, so it
    takes two joins for each binary digit of ``steps``."""
    reached = jumps.sparkSession.createDataFrame([(first,)], "entry bigint")
    for left in range(steps.bit_length() - 1, -1, -1):
        onward = reached.join(jumps, "entry").select(F.col("next").alias("entry"))
        reached = written(reached.unionByName(onward), "entries")
        if left:
            further = jumps.select(F.col("entry").alias("next"), F.col("next").alias("beyond"))
            jumps = written(jumps.join(further, "next").select("entry", F.col("beyond").alias("next")), "jumps")
    return [row[0] for row in reached.collect()]


def _closing_rows(
    chunks: DataFrame, order: str, limit: int, starts: dict[int, int], bases: dict[int, int]
) -> DataFrame:
    """The closing documents of the chunks in ``bases``, which has the base each is entered with."""

    def walk(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        ends = starts[key[0].as_py()] + np.cumsum(table["packed"].to_numpy())
        rows = _closers(ends, limit, bases[key[0].as_py()])
        return pa.table({order: table[order].take(pa.array(rows)), "end": pa.array(ends[rows], pa.int64())})

    order_type = chunks.schema[order].dataType.simpleString()
    visited = chunks.where(F.col("chunk").isin(list(bases)))
    return visited.groupBy("chunk").applyInArrow(walk, f"`{order}` {order_type}, end bigint")


def _keys(keys: list) -> np.ndarray:
    return np.array(keys, dtype=object if keys and isinstance(keys[0], str) else None)


def shard_column(
    documents: DataFrame, n_shards: int, order: str = "doc", size: str = "size", chunk_rows: int = 4_000_000
) -> Column:
    """The shard number as a column on ``order`` (a unique key) and ``size`` of ``documents``.

    Where a group closes depends on where the one before closed. To keep that chain short, keys and
    sizes are cut by range into chunks of about ``chunk_rows``, and all chunks work out at once where
    they would be left for every row that may close first in them, and which row of a later chunk
    closes next. The path through these rows is then followed by pointer jumping, in a number of jobs
    that grows with the logarithm of the number of chunks only. Knowing how each chunk is entered, all
    chunks list their closing documents at once.

    Fewer than ``n_shards`` documents end a shard (each such shard has more than its n-th part of
    the bytes), and these are all that is needed: a document is big and its own shard, or belongs to
    the next closing document. So texts get their shard where they are, without a join or shuffle.
    """
    spark = documents.sparkSession
    ship_package(spark)
    bytes_ = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    sizes = written(documents.select(order, bytes_.alias("size")), "sizes")
    rows, limit = sizes.agg(F.count(F.lit(1)), _limit(n_shards, "size")).first()
    big = F.col("size") > limit
    table = written(
        sizes.repartitionByRange(max(1, -(-rows // chunk_rows)), order).select(
            order,
            big.alias("big"),
            F.when(big, 0).otherwise(F.col("size")).alias("packed"),
            F.spark_partition_id().alias("chunk"),
        ),
        "shard_chunks",
        partition_by=["chunk"],
    )
    packed = table.select("chunk", order, "packed")
    starts, ends, largest, total = {}, [], [], 0  # one entry per chunk
    sums = table.groupBy("chunk").agg(F.sum("packed").alias("bytes"), F.max("packed").alias("largest"))
    for row in sums.orderBy("chunk").collect():
        starts[row["chunk"]] = total
        total += row["bytes"]
        ends.append(total)
        largest.append(row["largest"])

    numbers, bases = list(starts), {}
    first = bisect_right(ends, limit)  # the chunk in which the first group closes
    if first < len(ends):
        bases[numbers[first]] = 0
    if first + 1 < len(ends):
        bands = _bands(ends, largest, limit)
        exits = written(_exits(packed, order, limit, starts, ends, bands), "shard_exits", partition_by=["chunk"])
        begin = exits.where((F.col("chunk") == numbers[first]) & (F.col("entry") > limit)).agg(F.min("entry")).first()[0]
        jumps = written(_next_entries(exits, limit), "jumps")
        for entry in _reached(jumps, begin, min(n_shards, len(ends) - first)):
            bases[numbers[bisect_left(ends, entry)]] = entry - limit - 1

    closers = []  # fewer than n_shards keys
    if bases:
        found = _closing_rows(packed, order, limit, starts, bases).orderBy("end").collect()
        closers = [row[order] for row in found]
    bigs = [row[order] for row in table.where("big").select(order).orderBy(order).collect()]
    closing_order = {key: shard for shard, key in enumerate(sorted(closers + bigs))}

    lookup = spark.sparkContext.broadcast(
        {
            "closers": _keys(closers),
            "closer_shards": np.array([closing_order[k] for k in closers] + [len(closing_order)]),
            "bigs": _keys(bigs),
            "big_shards": np.array([closing_order[k] for k in bigs] + [-1]),
        }
    )

    @F.arrow_udf(LongType())
    def shard(keys: pa.Array, sizes: pa.Array) -> pa.Array:
        ends = lookup.value
        keys, big = keys.to_numpy(zero_copy_only=False), sizes.to_numpy() > limit
        own = ends["big_shards"][np.searchsorted(ends["bigs"], keys)] if len(ends["bigs"]) else -1
        group = np.searchsorted(ends["closers"], keys) if len(ends["closers"]) else np.zeros(len(keys), int)
        return pa.array(np.where(big, own, ends["closer_shards"][group]))

    return shard(F.col(order), bytes_)


def assign_shards(
    documents: DataFrame, n_shards: int, order: str = "doc", size: str = "size", chunk_rows: int = 4_000_000
) -> DataFrame:
    """Add ``shard BIGINT`` to ``documents``."""
    return documents.withColumn("shard", shard_column(documents, n_shards, order, size, chunk_rows))
