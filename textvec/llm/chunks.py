"""Documents dealt into chunks, so that a chunk can ask a large keyed table about all its keys at once.

Some operators look up something for every word or byte of a text. The table they look in grows with
the corpus, so it is never broadcast; instead the documents meet in chunks of a bounded number of
bytes, each chunk asks for its distinct keys, and the answers come back to the chunk. What moves is
the texts, compressed, and per chunk one row for each distinct key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, total_bytes


def dealt(docs: DataFrame, key: str, text: str, chunk_bytes: int) -> DataFrame:
    """``chunk, part``: the rows of ``docs`` by hash of ``key`` and ``text`` into chunks of about ``chunk_bytes``.

    A part holds the rows that one batch has for one chunk as a compressed Arrow stream. The chunk of a
    row depends on the row and the number of bytes in all, so it is the same whenever it is worked out.
    """
    n_chunks = max(1, -(-total_bytes(docs, text) // chunk_bytes))
    names = docs.columns

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        chunk = batch.column("_chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        found, first = np.unique(chunk[order], return_index=True)
        parts, codec = [], pa.ipc.IpcWriteOptions(compression="zstd")
        rows = batch.select(names)
        for low, high in zip(first, [*first[1:], len(chunk)], strict=True):
            part = rows.take(pa.array(order[low:high]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=codec) as writer:
                writer.write_batch(part)
            parts.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(parts, pa.binary())], ["chunk", "part"])

    chunk = F.pmod(F.xxhash64(key, text), F.lit(n_chunks)).cast("bigint")
    return map_batches(docs.withColumn("_chunk", chunk), pack, "chunk bigint, part binary")


def rows_of(parts: pa.Table) -> Iterator[pa.RecordBatch]:
    """The batches packed in a chunk's parts, one at a time."""
    for part in parts.column("part"):
        with pa.ipc.open_stream(part.as_buffer()) as reader:
            yield from reader


def each_chunk(parts: DataFrame, function: Callable[[int, Iterator[pa.RecordBatch]], pa.Table], schema: str) -> DataFrame:
    """``function`` of every chunk's id and batches."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        return function(key[0].as_py(), rows_of(table))

    return parts.groupBy("chunk").applyInArrow(run, schema)


def with_answers(
    parts: DataFrame,
    answers: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch], pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``function`` of every chunk's batches and of the rows that ``answers`` has for the chunk."""

    def run(table: pa.Table, found: pa.Table) -> pa.Table:
        return function(rows_of(table), found)

    return parts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)
