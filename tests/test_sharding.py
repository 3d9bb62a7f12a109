import random

import pytest
from pyspark.sql import functions as F

from textvec.operators import layout
from textvec.operators.sharding import assign_shards, shard_limit
from textvec.plans.pipeline import shard_directory
from textvec.plans.stages import shard_documents
from textvec.sinks.text import write_document_shards
from textvec.sources.text import read_lines


def _packed(sizes, n):
    """The rules step by step: a shard number for each document in order."""
    limit = sum(sizes) // n
    result, group, filled, count = [None] * len(sizes), [], 0, 0
    for i, size in enumerate(sizes):
        if filled > limit:
            for member in group:
                result[member] = count
            group, filled, count = [], 0, count + 1
        if size > limit:
            result[i] = count
            count += 1
        else:
            group.append(i)
            filled += size
    for member in group:
        result[member] = count
    return result


CASES = {
    "one shard": ([37, 58], 1),
    "second alone": ([37, 58], 2),
    "reversed": ([58, 37], 2),
    "all empty": ([0] * 7, 3),
    "more shards than bytes": ([0, 1, 0, 2, 0], 10),
    "exactly the limit does not close": ([5, 5, 5, 5], 2),
    "one huge": ([1] * 50 + [1000] + [1] * 50, 4),
    "empty after closing": ([10, 10, 0, 0, 10, 10, 0, 10], 3),
}
_rng = random.Random(3)
for _n in (1, 2, 7, 40):
    CASES[f"random {_n}"] = ([int(_rng.paretovariate(0.7)) - 1 for _ in range(300)], _n)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("chunk_rows", [1_000_000, 40])
def test_assign_shards(spark, name, chunk_rows):
    sizes, n = CASES[name]
    documents = spark.createDataFrame(list(enumerate(sizes)), "doc bigint, size bigint")
    found = assign_shards(documents.repartition(3), n, chunk_rows=chunk_rows).orderBy("doc").collect()
    assert [row["shard"] for row in found] == _packed(sizes, n)
    assert [row["size"] for row in found] == sizes


@pytest.mark.parametrize("n", [5, 150])
def test_groups_across_many_chunks(spark, n):
    """Groups longer and shorter than a chunk, keys in text order, runs of empty documents."""
    rng = random.Random(n)
    names = sorted(f"{i}.txt" for i in range(1500))
    sizes = [rng.choice([0, 0, 1, 3, 50, rng.randint(1, 400)]) for _ in names]
    documents = spark.createDataFrame(list(zip(names, sizes)), "doc string, size bigint").repartition(4)
    found = assign_shards(documents, n, chunk_rows=100).orderBy("doc").collect()
    assert [row["shard"] for row in found] == _packed(sizes, n)


def test_shards_exceed_the_limit_by_one_member_at_most(spark):
    sizes, n = CASES["random 40"]
    limit = sum(sizes) // n
    shards = {}
    for size, shard in zip(sizes, _packed(sizes, n)):
        shards.setdefault(shard, []).append(size)
    assert all(len(s) == 1 or sum(s[:-1]) <= limit for s in shards.values())


def test_limit(spark):
    documents = spark.createDataFrame([("a", 37), ("b", 58)], "doc string, size bigint")
    assert shard_limit(documents, 2).first()["shard_limit"] == 47
    with pytest.raises(ValueError):
        shard_limit(documents, 0)
    assert shard_limit(documents.where("size > 99"), 2).first()["shard_limit"] == 0


def test_shard_directory(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    (source / "text1.txt").write_text("health health banana banana exit exit")
    (source / "text2.txt").write_text("eat thinking thinking thinking salute salute salute window")
    (source / "other.dat").write_text("not a text")

    one = str(tmp_path / "one")
    shard_directory(spark, str(source), one, 1)
    rows = read_lines(spark, one, group=("shard",), across_files=True).orderBy("shard", "line_no").collect()
    # one shard, the last member first
    assert [(r["shard"], r["line"][:6]) for r in rows] == [(0, "eat th"), (0, "health")]

    two = str(tmp_path / "two")
    shard_directory(spark, str(source), two, 2)
    rows = read_lines(spark, two, group=("shard",)).collect()
    assert sorted((r["shard"], r["line"][:6]) for r in rows) == [(0, "eat th"), (1, "health")]

    with pytest.raises(Exception, match="already exists"):
        shard_directory(spark, str(source), two, 2)


def test_string_keys_and_other_columns(spark):
    documents = spark.createDataFrame([("b", 1, 5), ("a", 2, 9), ("c", 3, 5)], "doc string, x int, size bigint")
    found = assign_shards(documents, 2).orderBy("doc")
    assert found.columns == ["doc", "x", "size", "shard"]
    assert [r["shard"] for r in found.collect()] == _packed([9, 5, 5], 2)
    assert found.where(F.col("shard").isNull()).count() == 0


def test_no_documents_and_missing_sizes(spark):
    documents = spark.createDataFrame([("a", None), ("b", 4), ("c", None)], "doc string, size bigint")
    assert [r["shard"] for r in assign_shards(documents, 2).orderBy("doc").collect()] == _packed([0, 4, 0], 2)
    assert assign_shards(documents.where("doc > 'x'"), 2).collect() == []


def test_document_shards_in_order(spark, tmp_path, monkeypatch):
    """Members of a shard come last first, each with its lines in order, over several files."""
    texts = [(d, "\n".join(f"{d}:{n}" for n in range(d % 7 + 1))) for d in range(200)]
    documents = spark.createDataFrame(texts, "doc bigint, text string").repartition(3)
    monkeypatch.setattr(layout, "LEAST_BYTES", 500)
    write_document_shards(shard_documents(documents, 3), str(tmp_path / "out"))
    rows = read_lines(spark, str(tmp_path / "out"), group=("shard",), across_files=True).collect()
    shards = _packed([len(text) for _, text in texts], 3)
    for shard in set(shards):
        found = [r["line"] for r in sorted(rows, key=lambda r: r["line_no"]) if r["shard"] == shard]
        members = [text for (doc, text) in reversed(texts) if shards[doc] == shard]
        assert found == "\n".join(members).split("\n")
    assert len({(r["shard"], r["doc"]) for r in rows}) > 3
