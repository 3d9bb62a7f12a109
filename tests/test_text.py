import random
import re

import pytest
from pyspark.sql import functions as F

from textvec.functions import text


def _apply(spark, values, kind, expression):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    found = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in found]


def _python_lines(value):
    parts = re.split(r"\r\n|\r|\n", value)
    return parts[:-1] if parts[-1] == "" else parts


def test_split_lines(spark):
    rng = random.Random(1)
    values = ["", "\n", "a", "a\n", "a\n\nb\n", "a\r\nb\rc\n\r\nd", "\r", "\r\r\n\n", " \t", "é\r\n😀"]
    values += ["".join(rng.choices("ab\n\ré ", k=rng.randint(0, 30))) for _ in range(300)]
    found = _apply(spark, values, "string", text.split_lines)
    for value, pieces in zip(values, found):
        assert [p["line"] for p in pieces] == _python_lines(value), repr(value)
        whole = len(value.encode()) + (1 if pieces and not value.endswith(("\n", "\r")) and "\r" not in value else 0)
        assert sum(p["bytes"] for p in pieces) == whole


def test_drop_malformed(spark):
    rng = random.Random(2)
    parts = [b"a", "é".encode(), "😀".encode(), "�".encode(), "﷐".encode(), "﷑".encode(), "﷒".encode()]
    parts += [b"\xff", b"\xe2\x82", b"\xc0\x80", b"\xed\xa0\x80", b"\xf0\x9f", b"\x80", b"\n"]
    values = [b"a\xffb", b"", b"\xff"] + [b"".join(rng.choices(parts, k=12)) for _ in range(400)]
    found = _apply(spark, [bytearray(v) for v in values], "binary", text.drop_malformed)
    assert found == [v.decode("utf-8", "ignore") for v in values]


def test_trim_controls_keeps_other_spaces(spark):
    values = [" a ", "\x00\t a \r\n", " a", "", " \n "]
    assert _apply(spark, values, "string", text.trim_controls) == ["a", "a ", " a", "", ""]


def test_white_space_tokens(spark):
    """Only runs of space, tab, line and form feeds part tokens; a plain split is enough where there are just blanks."""
    rng = random.Random(3)
    values = [None, "", " ", "  a  b ", "a\tb", "\x0ba\x1cb\xa0c", "\u2003 d", "a\r\n\fb ", "😀 é  "]
    values += ["".join(rng.choices("abé  \t\n\r\f\x0b", k=rng.randint(0, 20))) for _ in range(200)]
    values += ["".join(rng.choices("abé  ", k=rng.randint(0, 20))) for _ in range(100)]
    expected = [None if v is None else [t for t in re.split(r"[ \t\n\r\f]+", v) if t] for v in values]
    assert _apply(spark, values, "string", text.white_space_tokens) == expected
    broken = [bytearray(b"a\xff \x80b  c"), bytearray(b"\xe2\x82\td\xe2 ")]  # as texts decode: U+FFFD for each part
    found = _apply(spark, broken, "binary", lambda c: text.white_space_tokens(c.cast("string")))
    assert found == [b.decode("utf-8", "replace").split() for b in broken]
    plan = spark.range(1).select(text.white_space_tokens(F.col("id").cast("string")))._jdf.queryExecution().toString()
    assert "lambda" not in plan and "CASE WHEN" in plan


def _string_hash(name):
    units = name.encode("utf-16-be")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + units[i] * 256 + units[i + 1]) % 2**32
    return h


def test_shard_of_name(spark):
    names = ["", "0.txt", "a.txt", "é.txt", "日本.txt", "😀.txt", "x" * 300 + ".txt"]
    expected = [_string_hash(n) for n in names]
    assert _apply(spark, names, "string", text.name_hash) == expected
    shards = _apply(spark, names, "string", lambda c: text.shard_of_name(c, 7))
    assert shards == [(h & 0x7FFFFFFF) % 7 for h in expected]
    with pytest.raises(ValueError):
        text.shard_of_name(F.col("v"), 0)


def test_ids_text_round_trip(spark):
    values = [[1, 20, 300], [7], []]
    assert _apply(spark, values, "array<int>", text.ids_to_text) == ["1 20 300", "7", ""]
    back = _apply(spark, ["1 20 300", " 7\t8 ", ""], "string", text.text_to_ids)
    assert back == [[1, 20, 300], [7, 8], []]


def test_composite_key(spark):
    (key,) = _apply(spark, ["3000000000#a#b.txt"], "string", text.parse_composite_key)
    assert (key["byte_offset"], key["doc"]) == (3_000_000_000, "a#b.txt")
