"""Column expressions on text; all of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# A cut after every line end, which leaves the end attached to its line.
_AFTER_LINE_END = r"(?<=\n)|(?<=\r)(?!\n)"

_REPLACEMENT = "�"
_ESCAPE, _ESCAPED_ESCAPE, _ESCAPED_REPLACEMENT = "﷐", "﷐﷑", "﷐﷒"


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def drop_malformed(text: Column) -> Column:
    """Text without its malformed UTF-8 bytes; ``text`` is binary or an unchecked string.

    Malformed bytes become U+FFFD and are deleted. A U+FFFD that the text holds itself is escaped
    before and restored after, so that it survives.
    """
    text = text.cast("string")
    escaped = _replace(_replace(text, _ESCAPE, _ESCAPED_ESCAPE), _REPLACEMENT, _ESCAPED_REPLACEMENT)
    kept = _replace(F.make_valid_utf8(escaped), _REPLACEMENT, "")
    restored = _replace(_replace(kept, _ESCAPED_REPLACEMENT, _REPLACEMENT), _ESCAPED_ESCAPE, _ESCAPE)
    return F.when(F.is_valid_utf8(text), text).otherwise(restored)


def trim_controls(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends (Spark's trim strips only spaces)."""
    return F.regexp_replace(text, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def pieces_with_ends(text: Column) -> Column:
    """The lines of a text, each with its line end."""
    return F.filter(F.split(text, _AFTER_LINE_END), lambda piece: piece != "")


def raw_pieces_with_ends(raw: Column) -> Column:
    """The same for unchecked strings. Splitting would replace malformed bytes, so it is done on the
    single-byte reading of the text, whose pieces are turned back into the bytes they came from."""
    pieces = pieces_with_ends(F.decode(raw.cast("binary"), "ISO-8859-1"))
    return F.transform(pieces, lambda piece: F.encode(piece, "ISO-8859-1").cast("string"))


def without_end(piece: Column) -> Column:
    """A piece without its line end (it has only one)."""
    return F.rtrim(piece, F.lit("\r\n"))


def split_lines(text: Column) -> Column:
    """Lines as array<struct<line, bytes>>, where bytes counts the line and its end.

    Ends are ``\\n``, ``\\r`` or ``\\r\\n``; a final line end opens no further line. Texts without
    ``\\r`` take the plain split, which needs no look-behind.
    """
    body = F.when(F.endswith(text, F.lit("\n")), F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    plain = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))
    return F.when(
        F.contains(text, F.lit("\r")),
        F.transform(
            pieces_with_ends(text),
            lambda p: F.struct(without_end(p).alias("line"), F.octet_length(p).alias("bytes")),
        ),
    ).otherwise(
        F.transform(plain, lambda p: F.struct(p.alias("line"), (F.octet_length(p) + 1).alias("bytes")))
    )


def white_space_tokens(line: Column) -> Column:
    """Tokens between runs of space, tab, line and form feeds, as array<string>.

    Lines with no other white space than blanks take the plain split, which needs no pattern."""
    others = [F.contains(line, F.lit(c)) for c in "\t\n\r\f"]
    pieces = F.when(reduce(Column.__or__, others), F.split(line, r"[ \t\n\r\f]+")).otherwise(F.split(line, " "))
    return F.array_remove(pieces, "")


def ids_to_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def text_to_ids(text: Column) -> Column:
    return white_space_tokens(text).cast("array<int>")


def name_hash(name: Column) -> Column:
    """The 31-polynomial hash of a name over its UTF-16 units, modulo 2**32."""

    def fold(units: Column, value) -> Column:
        return F.aggregate(
            units, F.lit(0).cast("bigint"), lambda h, u: (h * 31 + value(u)) % F.lit(1 << 32)
        )

    units = F.regexp_extract_all(F.hex(F.encode(name, "UTF-16BE")), F.lit("(.{4})"))
    # the characters of an ASCII name are its units: half the time
    return F.when(F.length(name) == F.octet_length(name), fold(F.split(name, ""), F.ascii)).otherwise(
        fold(units, lambda u: F.conv(u, 16, 10).cast("bigint"))
    )


def shard_of_name(name: Column, shards: int) -> Column:
    """Shard number of a document: its name's hash without the sign bit, modulo the shards."""
    if shards < 1:
        raise ValueError("the number of shards must be positive")
    return (name_hash(name).bitwiseAND(F.lit((1 << 31) - 1)) % F.lit(shards)).cast("int")


def parse_composite_key(key: Column) -> Column:
    """``"<offset>#<file>"`` as struct<byte_offset bigint, doc string>; the file may hold ``#``."""
    at = F.locate("#", key)
    return F.struct(
        F.substring(key, F.lit(1), at - 1).cast("bigint").alias("byte_offset"),
        F.substring(key, at + 1, F.length(key)).alias("doc"),
    )
