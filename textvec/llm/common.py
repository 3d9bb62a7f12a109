"""What several operators of this subpackage need."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textvec.workspace import ship_package

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no work column has, and the inner name of each column."""
    inner = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*inner.values()), inner


def unmasked(df: DataFrame, inner: dict[str, str]) -> DataFrame:
    return df.select(*(F.col(hidden).alias(name) for name, hidden in inner.items()))


def text_column(name: str = "text") -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    """The maximal runs without ASCII white space, as an array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def crc32_remainder(key: str, divisor: int) -> Column:
    """crc32 of a key's decimal text modulo ``divisor``; null keys have the text ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Each Arrow batch of ``df`` through ``function``, which yields batches of ``schema``."""
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def total_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over all rows, one number for the driver."""
    return df.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0
