"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame expressions only.

A line is its words; lines without a word are left alone. Two lines are near when one edit of a word
(replace, insert, delete) makes them equal and the shorter has ``MIN_WORDS`` words or more; equal lines
are near at any length. A line goes when a near line stands earlier, in order of document and line.

One edit leaves either the first or the last ``h`` words of both lines alone, where ``h`` is at most half
of the shorter one. So lines first look for another line with an equal head or tail, by hash; only
those that find one send out their deletion neighbourhood, the hash of the line without its i-th word
for every i (sums of hashes of word and place, so that it is linear in the line). Lines that replace
one word meet at the same place and hash, a line with one word more meets the shorter line itself.
Every key keeps only its earliest line, so a key that a third of all lines have costs one row per
line and no pairs. What meets is verified on the words.

Long texts travel twice: once for the lines that found a head or tail, once to cut lines out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textvec.llm.common import masked, unmasked
from textvec.workspace import written

MIN_WORDS = 5
LAST = (1 << 63) - 1  # the place of documents without an id: after all others


def _row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key).cast("bigint"), F.col(text))


def _half(n: Column) -> Column:
    """Words of the head and the tail of a line of n words: at most half, and mostly as for n - 1."""
    return F.when(n < MIN_WORDS, 0).when(n < 8, 2).otherwise(4 * F.floor(n / 8)).cast("int")


def _plain(line: Column) -> Column:
    """The words of a line with one blank between them."""
    return F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))


def _lines(docs: DataFrame) -> DataFrame:
    """``at, row, line, t`` of every line with a word: document and row it is in, its number, its words.

    As ``_plain``, but rare white space becomes blanks once for the text, and the regular expression
    runs over lines with two blanks in a row only."""
    blanks = F.translate("_text", "\t\x0b\x0c\r", "    ")
    rows = docs.select(
        F.coalesce(F.col("_id").cast("bigint"), F.lit(LAST)).alias("at"), "_row", F.split(blanks, "\n").alias("_lines")
    )
    lines = rows.select("at", F.col("_row").alias("row"), F.posexplode("_lines").alias("line", "text"))
    line = F.trim("text")
    plain = F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " {2,}", " ")).otherwise(line)
    return lines.select("at", "row", "line", plain.alias("t")).where("t <> ''")


def _identity() -> list[Column]:
    return [F.xxhash64("t").alias("id"), F.xxhash64(F.lit(1), F.col("t")).alias("id2")]


def _ends() -> Column:
    """Hashes of head and tail, at the half of this length and of the length below."""
    n, keys = F.col("n"), []
    below = F.when(_half(n) != _half(n - 1), _half(n - 1))
    for half in (_half(n), below):
        for side in (1, -1):
            part = F.call_function("substring_index", F.col("t"), F.lit(" "), half * side)
            keys.append(F.when(half > 0, F.xxhash64(F.lit(side), half, part)))
    return F.array_compact(F.array(*keys))


def _found(docs: DataFrame) -> DataFrame:
    """``row, line`` of every line that goes. ``docs`` has ``_id, _row, _text``."""
    blanks = F.octet_length("t") - F.octet_length(F.replace("t", F.lit(" "), F.lit("")))
    lines = _lines(docs).select("*", (blanks + 1).alias("n"))
    lines = written(lines.select("at", "row", "line", *_identity(), _ends().alias("ends")), "lines")
    first = F.min(F.struct("at", "row", "line"))
    same = written(lines.groupBy("id", "id2").agg(first.alias("first")), "same")
    ends = lines.select("id", "id2", F.explode("ends").alias("end"))
    met = ends.groupBy("end").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("end")
    some = ends.join(met, "end").select("id", "id2").distinct()
    near = written(same.join(some, ["id", "id2"]).select("id", "id2", "first"), "near")

    # the words of those lines, from the document that has each first
    wanted = near.groupBy(F.col("first.row").alias("_row")).agg(
        F.collect_set(F.struct(F.col("first.line").alias("line"), "id", "first")).alias("_wanted")
    )
    texts = docs.select("_row", "_text").join(wanted, "_row")
    split = texts.select(F.explode("_wanted").alias("x"), F.split("_text", "\n").alias("_lines"))
    known = split.select("x.id", "x.first", F.split(_plain(F.get("_lines", F.col("x.line"))), " ").alias("w"))
    known = written(known.dropDuplicates(["id", "first"]), "known")

    # sums of 40-bit hashes of word and place: without word i, later words move up by one
    place = Window.partitionBy("id", "first").orderBy("i")
    each = known.select("id", "first", F.size("w").alias("n"), F.posexplode("w").alias("i", "word"))
    hashed = each.select(
        "id", "first", "n", "i",
        F.shiftrightunsigned(F.xxhash64("word", "i"), 24).alias("here"),
        F.shiftrightunsigned(F.xxhash64("word", F.col("i") - 1), 24).alias("moved"),
    )
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = hashed.select(
        "id", "first", "n", "i", "here",
        F.sum("here").over(upto).alias("head"), F.sum("moved").over(upto).alias("gone"),
        F.sum("here").over(place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("whole"),
        F.sum("moved").over(place.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"),
    )
    shorter = sums.select(
        "id", "first", (F.col("n") - 1).alias("n"), "i",
        (F.col("head") - F.col("here") + F.col("all") - F.col("gone")).alias("key"),
    ).where(F.col("n") >= MIN_WORDS - 1)
    full = sums.where("i = 0").select("id", "first", "n", F.lit(None).cast("int").alias("i"), F.col("whole").alias("key"))
    variants = written(shorter.unionByName(full), "variants")
    # few keys are sent by two lines; only those go into the joins below
    sent = variants.groupBy("n", "key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b")
    variants = written(variants.join(sent.select("n", "key"), ["n", "key"]), "met")

    # replaced: the same place and hash, both lines of MIN_WORDS or more
    least = F.min(F.struct("first", "id"))
    places = variants.where("i is not null")
    replaced = (
        places.join(places.groupBy("n", "key", "i").agg(least.alias("best")), ["n", "key", "i"])
        .where("best.first < first")
        .select("id", F.col("i").alias("cut"), F.col("best.id").alias("by"), F.col("i").alias("by_cut"))
    )
    # one word more or less: the variant of the longer is the shorter line itself
    whole = variants.where(f"i is null and n >= {MIN_WORDS}")
    longer = F.min(F.struct("first", "id", "i"))
    inserted = (
        whole.join(places.groupBy("n", "key").agg(longer.alias("best")), ["n", "key"])
        .where("best.first < first")
        .select("id", "i", F.col("best.id").alias("by"), F.col("best.i").alias("by_cut"))
    ).toDF("id", "cut", "by", "by_cut")
    deleted = (
        places.join(whole.groupBy("n", "key").agg(least.alias("best")), ["n", "key"])
        .where("best.first < first")
        .select("id", F.col("i").alias("cut"), F.col("best.id").alias("by"), F.lit(None).cast("int").alias("by_cut"))
    )
    pairs = replaced.unionByName(inserted).unionByName(deleted)

    def without(w: str, cut: str) -> Column:
        i = F.col(cut)
        rest = F.concat(F.slice(w, F.lit(1), i), F.slice(w, i + 2, F.size(w)))
        return F.array_join(F.when(i.isNull(), F.col(w)).otherwise(rest), " ")

    mine = known.select("id", "w", F.col("first").alias("mine"))
    other = known.select(F.col("id").alias("by"), F.col("w").alias("by_w"), F.col("first").alias("theirs"))
    verified = (
        pairs.join(mine, "id").join(other, "by").where("theirs < mine")
        .where(without("w", "cut") == without("by_w", "by_cut")).select("mine").distinct()
    )
    later = (
        lines.select("at", "row", "line", "id", "id2").join(same.select("id", "id2", "first"), ["id", "id2"])
        .where(F.struct("at", "row", "line") != F.col("first"))
        .select("row", "line")
    )
    return later.union(verified.select("mine.row", "mine.line"))


def cut_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_cut``, the numbers of the lines that go, ascending; null where none does.

    Rows that are equal in id and text are the same place: neither is earlier, so both keep the same
    lines. Rows with one id and different texts are ordered by a hash of the text. Documents without an id
    come last.
    """
    keyed = docs.withColumn("_row", _row_hash(key, text))
    found = _found(keyed.select(F.col(key).alias("_id"), "_row", F.coalesce(F.col(text), F.lit("")).alias("_text")))
    cut = found.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_set("line")).alias("_cut"))
    return keyed.join(cut, "_row", "left").drop("_row").withColumn("_text", F.coalesce(F.col(text), F.lit("")))


def _kept_text() -> Column:
    kept = F.filter(F.split("_text", "\n"), lambda line, i: ~F.array_contains("_cut", i))
    kept = F.array_join(kept, "\n")
    return F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(kept)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows and columns of ``docs``, texts without the lines that go.

    A document of which only blank lines would be left goes as a whole; one that had no word before
    stays as it is. A null text stays null. An empty table gives no rows.
    """
    hidden, inner = masked(docs)
    done = cut_lines(hidden, inner[key], inner[text]).withColumn("_new", _kept_text())
    done = done.where(F.col("_cut").isNull() | F.col("_new").rlike(r"[^\x20\x09-\x0D]"))
    new = F.when(F.col("_cut").isNull(), F.col(inner[text])).otherwise(F.col("_new"))
    return unmasked(done.withColumn(inner[text], new), inner)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_cut, kept_chars, kept_sha256`` of every document after its lines are cut."""
    done = cut_lines(docs.select("doc_id", "text")).withColumn("_new", _kept_text())
    return done.select(
        "doc_id",
        (F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_cut"), F.lit(0)).cast("bigint").alias("n_cut"),
        F.length("_new").cast("bigint").alias("kept_chars"),
        F.sha2(F.col("_new"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents
), raw AS (
  SELECT doc_id, CAST(generate_subscripts(p, 1) AS BIGINT) AS line, unnest(p) AS raw FROM parts
), plain AS (
  SELECT *, trim(regexp_replace(raw, '[\\x20\\x09-\\x0D]{{2,}}|[\\x09-\\x0D]', ' ', 'g'), ' ') AS t FROM raw
), d AS (
  SELECT t, min(row(doc_id, line)) AS first, string_split(t, ' ') AS w FROM plain WHERE t <> '' GROUP BY t
), v AS (
  SELECT t, first, len(w) AS n, i, md5(array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ')) AS s
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) >= {MIN_WORDS})
), near AS (
  SELECT a.t FROM v a JOIN v b ON a.n = b.n AND a.i = b.i AND a.s = b.s WHERE b.first < a.first
  UNION SELECT a.t FROM d a JOIN v b ON md5(a.t) = b.s WHERE len(a.w) >= {MIN_WORDS} AND b.first < a.first
  UNION SELECT a.t FROM v a JOIN d b ON a.s = md5(b.t) WHERE len(b.w) >= {MIN_WORDS} AND b.first < a.first
), marked AS (
  SELECT p.doc_id, p.line, p.raw,
         p.t <> '' AND (near.t IS NOT NULL OR row(p.doc_id, p.line) <> d.first) AS cut
  FROM plain p LEFT JOIN d ON p.t = d.t LEFT JOIN near ON p.t = near.t
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (cut) AS n_cut,
       CAST(length(coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (NOT cut), '')) AS BIGINT) AS kept_chars,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (NOT cut), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
