"""Lines of documents, from tables and from text files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions.text import drop_malformed, raw_pieces_with_ends, split_lines, without_end
from ..operators.totals import running_totals
from ..workspace import ship_package


@F.arrow_udf(ArrayType(LongType()))
def _starts(sizes: pa.Array) -> pa.Array:
    """Running sums inside each list, each without its own element."""
    lists = sizes.offsets.to_numpy() - sizes.offsets[0].as_py()
    ends = np.concatenate([[0], np.cumsum(sizes.flatten().to_numpy(), dtype=np.int64)])
    before = ends[:-1] - np.repeat(ends[lists[:-1]], np.diff(lists))
    return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(before))


def _file_name() -> Column:
    """The name of the file a row comes from; Spark gives it as a part of a URI."""
    name = F.col("_metadata.file_name")
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def table_lines(
    documents: DataFrame,
    doc: str = "doc",
    text: str = "text",
    offsets: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc, <keep>, line_no, [byte_offset,] line`` of a table with one text per row.

    Line numbers come from the position in the split, so nothing is shuffled. For offsets only the
    array of line sizes goes through Python.
    """
    lines = split_lines(F.col(text))
    line_no = F.col("line_no").cast("bigint").alias("line_no")
    if not offsets:
        # exploded as an expression: for a column Catalyst adds a filter that splits a second time
        pieces = F.posexplode(lines).alias("line_no", "piece")
        rows = documents.select(F.col(doc).alias("doc"), *keep, pieces)
        return rows.select("doc", *keep, line_no, "piece.line")
    ship_package(documents.sparkSession)
    split = documents.select(F.col(doc).alias("doc"), *keep, lines.alias("lines"))
    placed = split.withColumn("starts", _starts(F.col("lines.bytes")))
    pieces = F.posexplode(F.arrays_zip("lines.line", "starts")).alias("line_no", "piece")
    return placed.select("doc", *keep, pieces).select(
        "doc", *keep, line_no, F.col("piece.starts").alias("byte_offset"), "piece.line"
    )


def list_text_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, doc, size`` of the ``*.txt`` files directly in a directory; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.txt")
        .option("recursiveFileLookup", False)
        .load(path)
    )
    return files.select(
        "path", F.substring_index("path", "/", -1).alias("doc"), F.col("length").alias("size")
    ).where(F.length("doc") > 4)


def read_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    group: tuple[str, ...] = (),
    across_files: bool = False,
    file_size: bool = False,
    numbered: bool = True,
) -> DataFrame:
    """``doc, line_no, byte_offset, line`` of the text files in a directory; doc is the file name.

    Files are split like any text source, so one huge file is read by many tasks, and still every
    line gets its exact number and offset: lines are counted per file split, and splits are counted
    up per file, or over all files in name order with ``across_files``. ``group`` names partition
    columns of the directory, which are kept and numbered apart. Malformed bytes are dropped.
    ``file_size`` adds the ``size`` of the file.

    Numbering shuffles the lines once, by file split. Stages that need only the order of lines read
    with ``numbered=False``: ``line_no`` is then the sortable position of the line (file split, row
    and part of the row, after the file with ``across_files``), there is no ``byte_offset``, and
    nothing is shuffled.
    """
    extra = ["size"] if file_size else []
    raw = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)
    raw = raw.select(
        *group,
        _file_name().alias("doc"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        F.concat("value", F.lit("\n")).alias("piece"),
        *([F.col("_metadata.file_size").alias("size")] if file_size else []),
    )
    # a lone \r ends a line too
    pieces = F.when(F.contains("piece", F.lit("\r")), raw_pieces_with_ends(F.col("piece"))).otherwise(
        F.array("piece")
    )
    lines = raw.select(*group, *extra, "doc", "_block", "_row", F.posexplode(pieces).alias("_part", "piece"))
    line = without_end(drop_malformed(F.col("piece"))).alias("line")
    if not numbered:
        file = ["doc"] if across_files else []
        position = F.struct(*file, "_block", "_row", "_part").alias("line_no")
        return lines.select(*group, "doc", *extra, position, line)
    counted = running_totals(
        lines,
        [*group] if across_files else [*group, "doc"],
        ["doc", "_block"] if across_files else ["_block"],
        ["_row", "_part"],
        {"line_no": F.lit(1), "byte_offset": F.octet_length("piece")},
    )
    return counted.select(*group, "doc", *extra, "line_no", "byte_offset", line)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``doc, line_no, line`` of a directory of texts, in the order of the lines but not numbered.

    A document is a file, or a shard as written by ``write_shards``: shard ``n`` is the document
    ``<n>.txt``, whatever the number of its files.
    """
    if "shard" not in spark.read.text(path).columns:
        return read_lines(spark, path, numbered=False)
    lines = read_lines(spark, path, group=("shard",), across_files=True, numbered=False)
    doc = F.concat(F.col("shard").cast("string"), F.lit(".txt")).alias("doc")
    return lines.select(doc, "line_no", "line")
