"""Chat formatting after collapsing cumulative snapshots, in DataFrame expressions only.

Chat logs often store a conversation again after every turn. A conversation whose turns are the first
turns of a longer one is such a snapshot. Every turn gets the rolling hash of the turns up to it: the sum
of hashes of place, role and text, 80 bits in all, by two-level running totals, so that a conversation
of any length is never gathered for it. A conversation goes by an anti-join if its last hash is an
inner one of some conversation, and of equal conversations the smallest id stays. What is left is
rendered; only there the turns of one conversation meet, as its text is one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textvec.operators.totals import running_totals
from textvec.workspace import written

# fixed values: the marks of the template
START, END = "<|im_start|>", "<|im_end|>"
CHUNK = 256  # turn numbers per window


def _numbered(turns: DataFrame) -> DataFrame:
    """``conv, place, role, text``: turns by number, equal numbers by role and text; places from 1."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce("conv_id", F.lit(0)).cast("bigint").alias("_a"),
        F.col("conv_id").isNull().alias("_b"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(1 << 62)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    placed = running_totals(rows, ["_a", "_b"], ["chunk"], ["turn", "role", "text"], {"before": F.lit(1)})
    return placed.withColumn("place", F.col("before") + 1).drop("before")


def _hash(seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "place", "role", "text"), 24)


def maximal(turns: DataFrame) -> DataFrame:
    """The turns, as ``conv_id, place, role, text``, of the conversations that are no snapshot or copy."""
    placed = _numbered(turns).withColumns({"h1": _hash(1), "h2": _hash(2)})
    placed = written(placed, "turns")
    place = running_totals(
        placed.select("_a", "_b", "place", F.floor(F.col("place") / CHUNK).alias("part"), "h1", "h2"),
        ["_a", "_b"], ["part"], ["place"], {"s1": F.col("h1"), "s2": F.col("h2")},
    )
    prefix = place.select(
        "_a", "_b", "place", (F.col("s1") + F.col("h1")).alias("p1"), (F.col("s2") + F.col("h2")).alias("p2")
    )
    size = placed.groupBy("_a", "_b").agg(F.max("place").alias("n"))
    prefix = written(prefix.join(size, ["_a", "_b"]), "prefixes")
    inner = prefix.where("place < n").select("place", "p1", "p2").distinct()
    whole = prefix.where("place = n").groupBy("place", "p1", "p2").agg(F.min(F.struct("_b", "_a")).alias("first"))
    kept = whole.join(inner, ["place", "p1", "p2"], "left_anti").select("first._a", "first._b")
    return placed.join(kept, ["_a", "_b"], "left_semi").select("conv_id", "place", "role", "text")


def _escaped(text: str) -> Column:
    """Marks of the template inside a text, broken by a blank."""
    return F.replace(F.replace(F.col(text), F.lit(START), F.lit("<| im_start|>")), F.lit(END), F.lit("<| im_end|>"))


def rendered(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, rendered`` of every maximal conversation.

    Turns without a number come last, a missing role is ``unknown``, a missing text empty. Turns without
    a ``conv_id`` form one conversation. Rows that repeat are turns that repeat. An empty table gives no
    rows; further columns are ignored.
    """
    turn = F.concat(F.lit(START), _escaped("role"), F.lit("\n"), _escaped("text"), F.lit(END + "\n"))
    whole = maximal(turns).select("conv_id", F.struct("place", turn.alias("part")).alias("turn"))
    joined = whole.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return joined.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.array_join("turns.part", "").alias("rendered")
    )


ORACLE = """
WITH t AS (
  SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) AS place
  FROM conversations
), c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(31) || text || chr(30), '' ORDER BY place) AS whole,
         string_agg('<|im_start|>'
           || replace(replace(role, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>') || chr(10)
           || replace(replace(text, '<|im_start|>', '<| im_start|>'), '<|im_end|>', '<| im_end|>')
           || '<|im_end|>' || chr(10), '' ORDER BY place) AS rendered
  FROM t GROUP BY conv_id
)
SELECT a.conv_id, a.n_turns, a.rendered FROM c a
WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.n_turns > a.n_turns AND starts_with(b.whole, a.whole))
  AND NOT EXISTS (SELECT 1 FROM c b WHERE b.whole = a.whole AND b.conv_id < a.conv_id)
"""
