import pytest
from pyspark.sql import functions as F

from textvec.sources.text import list_text_files, read_lines, table_lines

FILES = {
    "a.txt": b"one\ntwo\n\nthree",
    "b.txt": b"x\r\n\r\ny\rz\n",
    "empty.txt": b"",
    "blank.txt": b"\n\n \n",
    "broken.txt": b"a\xffb\ncaf\xc3\xa9\n",
    "broken_ends.txt": b"a\xff\r\n\xe2\x82\rcaf\xc3\xa9\xc3\n\xef\xbf\xbd\r",
    "long.txt": b"".join(b"line %d of many\n" % i for i in range(5000)),
}


@pytest.fixture
def directory(tmp_path):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content)
    return tmp_path


def _expected(content):
    """(line_no, offset, line) by hand."""
    rows, start, at = [], 0, 0
    while at < len(content):
        if content[at : at + 2] == b"\r\n":
            end = 2
        elif content[at : at + 1] in (b"\r", b"\n"):
            end = 1
        else:
            at += 1
            if at < len(content):
                continue
            end = 0
        rows.append((len(rows), start, content[start:at].decode("utf-8", "ignore")))
        at += end
        start = at
    return rows


@pytest.mark.parametrize("split_bytes", ["128m", "1k"])
def test_read_lines(spark, directory, split_bytes):
    """Numbers and offsets do not depend on how many tasks read a file."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        rows = read_lines(spark, str(directory)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, content in FILES.items():
        found = sorted((r["line_no"], r["byte_offset"], r["line"]) for r in rows if r["doc"] == name)
        assert found == _expected(content), name


def test_positions_sort_like_numbers(spark, directory):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        lines = read_lines(spark, str(directory), numbered=False)
        assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
        rows = lines.orderBy("doc", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [(name, row[2]) for name in sorted(FILES) for row in _expected(FILES[name])]
    assert [(r["doc"], r["line"]) for r in rows] == expected


def test_read_lines_across_files(spark, directory):
    rows = read_lines(spark, str(directory), across_files=True).orderBy("line_no").collect()
    lines = [row[2] for name in sorted(FILES) for row in _expected(FILES[name])]
    assert [r["line"] for r in rows] == lines
    assert [r["line_no"] for r in rows] == list(range(len(lines)))


def test_table_lines(spark):
    texts = {i: content.decode("utf-8", "ignore") for i, content in enumerate(FILES.values())}
    documents = spark.createDataFrame([*texts.items(), (99, None)], "doc bigint, text string")
    with_offsets = table_lines(documents, offsets=True).collect()
    for doc, value in texts.items():
        found = sorted((r["line_no"], r["byte_offset"], r["line"]) for r in with_offsets if r["doc"] == doc)
        assert found == _expected(value.encode()), doc
    plain = table_lines(documents).collect()
    assert sorted((r["doc"], r["line_no"], r["line"]) for r in plain) == sorted(
        (r["doc"], r["line_no"], r["line"]) for r in with_offsets
    )


def test_plain_lines_are_not_shuffled(spark, directory):
    documents = spark.read.text(str(directory), wholetext=True).select(
        F.col("_metadata.file_name").alias("doc"), F.col("value").alias("text")
    )
    plan = table_lines(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_list_text_files(spark, tmp_path):
    for name in ("a.txt", "b.TXT", "c.dat", ".txt", "d.txt"):
        (tmp_path / name).write_bytes(b"x" * len(name))
    (tmp_path / "deeper").mkdir()
    (tmp_path / "deeper" / "e.txt").write_bytes(b"no")
    found = list_text_files(spark, str(tmp_path)).select("doc", "size").collect()
    assert sorted(map(tuple, found)) == [("a.txt", 5), ("d.txt", 5)]


def test_file_names_are_plain(spark, tmp_path):
    """Both readers give the name itself, as sharding joins on it by value."""
    names = ["a b.txt", "c#d.txt", "e%20f.txt", "g+h.txt", "i+ j%.txt", "é.txt"]
    for name in names:
        (tmp_path / name).write_text("x\n")
    assert sorted(r["doc"] for r in list_text_files(spark, str(tmp_path)).collect()) == names
    assert sorted(r["doc"] for r in read_lines(spark, str(tmp_path)).collect()) == names
