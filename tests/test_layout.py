"""Rows laid out by bytes: exact order, even files, and rows that are read once."""

import random

import pytest
from pyspark.sql import functions as F

from textvec.operators import layout
from textvec.operators.layout import in_order
from textvec.sinks.text import write_document_shards
from textvec.workspace import written


def _rows(spark, key, n_docs=60, hot=40, seed=1):
    """``shard, doc, line_no, line``; shard 1 has a document with a third of all lines."""
    rng = random.Random(seed)
    rows = []
    for d in range(n_docs):
        n = 700 if d == hot else rng.randint(0, 40)
        rows += [(d % 3, key(d), i, "x" * rng.randint(0, 30)) for i in range(n)]
    rng.shuffle(rows)
    kind = "string" if isinstance(key(0), str) else "bigint"
    return spark.createDataFrame(rows, f"shard int, doc {kind}, line_no bigint, line string").repartition(5)


def _stored_order(df, path):
    df.write.parquet(path)
    rows = df.sparkSession.read.parquet(path).select(
        "shard", "doc", "line_no", "line", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r")
    )
    return rows.orderBy("f", "r").collect()


@pytest.mark.parametrize("key", [lambda d: d * 7 - 50, lambda d: f"{d}.txt"], ids=["numbers", "names"])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("part_bytes", [300, 1000, 10**6])
def test_order_and_parts(spark, tmp_path, key, descending, part_bytes):
    rows = written(_rows(spark, key), "rows")
    sizes = layout.line_sizes(rows, F.octet_length("line") + 1)
    ordered = in_order(rows, sizes, "doc", "shard", "line_no", descending, part_bytes)
    found = [tuple(r)[:3] for r in _stored_order(ordered, str(tmp_path / "out"))]
    docs = sorted({r[:2] for r in found}, key=lambda k: k[1], reverse=descending)
    place = {k: i for i, k in enumerate(sorted(docs, key=lambda k: k[0]))}
    assert found == sorted(found, key=lambda r: (place[r[:2]], r[2]))
    assert len(found) == rows.count()
    if part_bytes == 1000:
        size = ordered.groupBy(F.spark_partition_id()).agg(F.sum(F.octet_length("line") + 1).alias("n")).collect()
        sizes = sorted(r["n"] for r in size)[1:]  # but for the last part
        assert len(sizes) > 10 and max(sizes) < 2 * min(sizes)


def test_the_order_is_right_with_wrong_sizes(spark, tmp_path):
    """Sizes decide how even parts are, not the order: missing members, none at all, negative shards."""
    rows = _rows(spark, str).withColumn("shard", F.col("shard") - 1)
    sizes = layout.line_sizes(rows, F.lit(5)).where("cast(doc as int) % 4 > 0")
    for i, some in enumerate([sizes, sizes.where("false"), sizes.withColumn("size", F.lit(None).cast("bigint"))]):
        found = [tuple(r)[:3] for r in _stored_order(in_order(rows, some, "doc", "shard", "line_no", False, 900), str(tmp_path / str(i)))]
        assert found == sorted(found) and len(found) == rows.count()


def test_rows_are_read_once(spark):
    rows = written(_rows(spark, str), "rows")
    sizes = written(layout.line_sizes(rows, F.lit(1)), "sizes")
    ordered = in_order(rows, sizes, "doc", "shard", "line_no", False, 200)
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "rangepartitioning" not in plan


def test_files_of_a_hot_shard_are_even(spark, tmp_path, monkeypatch):
    """One shard with a third of all bytes: its files have about the same size."""
    monkeypatch.setattr(layout, "LEAST_BYTES", 2000)
    monkeypatch.setattr(layout, "MOST_BYTES", 2000)
    rng = random.Random(8)
    texts = [(0 if d < 200 else 1 + d % 9, d, "\n".join("y" * rng.randint(1, 40) for _ in range(5))) for d in range(600)]
    documents = spark.createDataFrame(texts, "shard int, doc bigint, text string").repartition(4)
    write_document_shards(documents, str(tmp_path / "out"))
    files = sorted(f.stat().st_size for f in (tmp_path / "out" / "shard=0").glob("part-*"))
    assert len(files) > 8 and files[-1] < 2 * files[1]  # the first file may end an earlier part
