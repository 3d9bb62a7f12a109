"""Quality rules: simple limits, then robust multivariate outliers per language and source.

Every document becomes five counts and a vector of five transformed statistics. Per language and
source a minimum-covariance-determinant estimate finds the three quarters of the documents whose
covariance has the smallest determinant: from a start by medians and quartiles, each step takes the
documents with the smallest Mahalanobis distances and estimates centre and covariance from them
again, which never raises the determinant, until they stay the same. Documents beyond the cut-off are
rejected.

All of it is DataFrame expressions: aggregates per group, a Cholesky factor in columns of the
group table, distances by forward substitution, and quantiles from histograms on a fixed grid (so
that a group may hold any share of the rows, and no result depends on the order of rows).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textvec.llm.common import SPACE
from textvec.workspace import written

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
VECTOR = ("x0", "x1", "x2", "x3", "x4")
# The least standard deviation that counts, for each transformed statistic: most documents have no symbol
# and no repeat at all, and without it the first one would be infinitely far from them.
LEAST_SCALE = (0.25, 0.05, 0.25, 0.4, 0.15)
SHARE = 0.75
# fixed values of the chi-squared law with five degrees of freedom: what makes the covariance of the
# inner three quarters consistent, and the 0.9999 quantile
CONSISTENCY, CUT_OFF = 1.412, 25.745
MIN_GROUP = 100
MAX_STEPS = 30
SAME = 1e-4  # steps end when log determinants and centres, summed over the groups, change by less
GRID = 64  # histogram cells per unit


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the five counts of ``STATS``; a null text has none of anything."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select(*keep, text.alias("_text"))
    df = df.select(*keep, "_text", F.array_remove(F.split("_text", SPACE), "").alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window = F.transform(
        "_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2))
    )
    df = df.select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
        F.when(F.size("_words") >= 3, F.slice(window, F.lit(1), F.size("_words") - 2)).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    places = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(
        *keep, *STATS[:3], (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(repeats, places).alias("_places"),
    )
    twice = F.filter(
        "_places",
        lambda x, i: (F.get("_places", i - 1)["h"].eqNullSafe(x["h"]))
        | (F.get("_places", i + 1)["h"].eqNullSafe(x["h"])),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    df = df.select(*keep, *STATS[:4], starts.alias("_starts"))
    covered = F.transform("_starts", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_starts", j + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.select(*keep, *STATS[:4], F.coalesce(total, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vector() -> list[Column]:
    """Length, word length, symbols per character, repeated lines, share of repeated words."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    columns = [
        F.log(n.cast("double")),
        F.log(chars / n),
        F.log1p(100 * F.col("n_symbols") / chars),
        F.log1p(F.col("n_dup_lines").cast("double")),
        F.sqrt(F.col("n_repeat_words") / n),
    ]
    return [c.cast("double").alias(name) for c, name in zip(columns, VECTOR, strict=True)]


def _pooled(df: DataFrame, group: list[str]) -> DataFrame:
    """``df`` with the key of its group; groups under ``MIN_GROUP`` fitted rows join others of their language, then all."""
    first, second = group
    df = df.withColumn("_a", F.coalesce(F.col(first).cast("string"), F.lit("")))
    df = df.withColumn("_b", F.coalesce(F.col(second).cast("string"), F.lit("")))
    sizes = df.groupBy("_a", "_b").agg(F.count_if(~F.col("base_failed")).alias("_n"))
    sizes = sizes.withColumn("_key", F.when(F.col("_n") >= MIN_GROUP, F.to_json(F.array("_a", "_b"))))
    left = sizes.where("_key is null").groupBy("_a").agg(F.sum("_n").alias("_m"))
    keys = sizes.join(left, "_a", "left").select(
        "_a", "_b",
        F.coalesce("_key", F.when(F.col("_m") >= MIN_GROUP, F.to_json(F.array("_a"))), F.lit("[]")).alias("_key"),
    )
    return df.join(keys, ["_a", "_b"]).drop("_a", "_b")


def _quantiles(values: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Per key the smallest ``cell`` up to which at least each share of the rows lies; cells are on a grid."""
    cells = values.groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy(*keys).orderBy("cell")
    cells = cells.select(
        *keys, "cell", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy(*keys)).alias("all")
    )
    return cells.groupBy(*keys).agg(
        *(F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("cell"))).alias(k) for k, share in shares.items())
    )


def _start(rows: DataFrame) -> DataFrame:
    """Centres by medians and diagonal factors by quartiles."""
    long = rows.select("_key", F.posexplode(F.array(*VECTOR)).alias("i", "x"))
    long = long.select("_key", "i", F.floor(F.col("x") * 4 * GRID).alias("cell"))
    found = _quantiles(long, ["_key", "i"], {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    scale = (F.col("q3") - F.col("q1")) / (4 * GRID * 1.349)
    least = F.element_at(F.array(*map(F.lit, LEAST_SCALE)), F.col("i") + 1)
    found = found.select("_key", "i", (F.col("q2") / (4 * GRID)).alias("m"), F.greatest(scale, least).alias("s"))
    wide = found.groupBy("_key").pivot("i", list(range(5))).agg(F.first("m").alias("m"), F.first("s").alias("s"))
    columns = [F.col(f"{i}_m").alias(f"m{i}") for i in range(5)]
    columns += [
        (F.col(f"{i}_s") if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(5) for j in range(i + 1)
    ]
    return wide.select("_key", *columns)


def _distance(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance, by forward substitution; null without a factor."""
    names = rows.columns
    df = rows.join(factors, "_key", "left")
    for i in range(5):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        df = df.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 5)), F.col("y0") * F.col("y0"))
    return df.select(*names, total.alias("d2"))


def _estimate(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """One step: centre and Cholesky factor of the ``SHARE`` of each group that is nearest by ``factors``."""
    near = _distance(rows, factors).withColumn("cell", F.floor(F.log(F.col("d2") + 1e-6) * GRID))
    edge = _quantiles(near.select("_key", "cell"), ["_key"], {"edge": SHARE})
    inner = near.join(edge, "_key").where(F.col("cell") <= F.col("edge"))
    sums = [F.count("*").cast("double").alias("n"), *(F.sum(x).alias(f"s_{x}") for x in VECTOR)]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(5) for j in range(i + 1)]
    g = inner.groupBy("_key").agg(*sums)
    g = g.select("*", *((F.col(f"s_x{i}") / F.col("n")).alias(f"m{i}") for i in range(5)))
    cov = []
    for i in range(5):
        for j in range(i + 1):
            value = CONSISTENCY * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + LEAST_SCALE[i] ** 2
            cov.append(value.alias(f"c{i}{j}"))
    g = g.select("_key", *(f"m{i}" for i in range(5)), *cov)
    for i in range(5):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
            g = g.withColumn(f"l{i}{j}", value)
    return g.select("_key", *(f"m{i}" for i in range(5)), *(f"l{i}{j}" for i in range(5) for j in range(i + 1)))


def _digest(factors: DataFrame) -> list[float]:
    determinant = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, 5)), F.log(F.col("l00")))
    row = factors.agg(F.sum(determinant), *(F.sum(f"m{i}") for i in range(5))).first()
    return [x or 0.0 for x in row]


def judged(
    docs: DataFrame, group: tuple[str, str] = ("lang", "source"), keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, the counts, ``base_failed``, ``distance`` and ``kept``, one row per row of ``docs``.

    Null texts are empty and so fail the base rules. A null language or source is a group value of
    its own. Where fewer than ``MIN_GROUP`` documents can be fitted even over all small groups
    together, the method rejects nothing there. ``distance`` is null where a document is not judged.
    Rows that repeat are judged alike, an empty table gives no rows, further columns are ignored.
    """
    first, second = group
    columns = list(dict.fromkeys((*keep, first, second)))
    stats = statistics(docs.select(*columns, "text"), columns).withColumn("base_failed", base_failed())
    renamed = stats.select(
        *(F.col(c).alias(f"k_{c}") for c in columns), *STATS, "base_failed", *_vector()
    )
    rows = written(_pooled(renamed, [f"k_{first}", f"k_{second}"]), "statistics")
    fitted = rows.where("not base_failed").select("_key", *VECTOR)
    sizes = fitted.groupBy("_key").agg(F.count("*").alias("_n")).where(F.col("_n") >= MIN_GROUP).select("_key")
    fitted = fitted.join(sizes, "_key", "left_semi")
    factors = written(_start(fitted), "factors")
    factors = written(_estimate(fitted, factors), "factors")
    before, now = None, _digest(factors)
    for _ in range(MAX_STEPS):
        if before and all(math.isclose(a, b, rel_tol=SAME, abs_tol=SAME) for a, b in zip(before, now, strict=True)):
            break
        factors = written(_estimate(fitted, factors), "factors")
        before, now = now, _digest(factors)
    measured = _distance(rows, factors)
    far = F.coalesce(F.col("d2") > CUT_OFF, F.lit(False))
    return measured.select(
        *(F.col(f"k_{c}").alias(c) for c in keep), *STATS, "base_failed",
        F.when(~F.col("base_failed"), F.sqrt("d2")).alias("distance"),
        (~F.col("base_failed") & ~far).alias("kept"),
    )
