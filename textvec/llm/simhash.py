"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into segments on a ring. Where two fingerprints differ in at most ``t`` of
their bits, some segment starts a chain whose first ``l`` segments together differ in at most
``l * t / m`` bits, for every length ``l`` (``m`` segments). For three segments and ``t = 2`` that is:
one segment equal, it and the next with at most one difference, all three with at most two. The
equal segment, and the half of the next one that the single difference leaves alone, form a key of
31 bits or more; candidates meet on it, pass the chain, and only then the full Hamming check.

Buckets with more than ``BUCKET`` fingerprints are not paired. Their fingerprints link through shared
neighbours instead: two differ in at most two bits exactly when some value is within one bit of
both, so each sends its 65 nearest values and the smallest sender per value links all others.
That is exact too, and grows with the members, not with their pairs.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, masked, text_column, unmasked
from textvec.llm.components import components
from textvec.workspace import written

BUCKET = 64
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width


def shingle_hashes(text: bytes, size: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``size`` words of the lower-cased text, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    columns = [words[i:] for i in range(size)]
    shingles = map(b" ".join, zip(*columns, strict=False)) if len(words) >= size else [b" ".join(words)]
    n = max(1, len(words) - size + 1)
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, n)


def majority(hashes: np.ndarray) -> np.ndarray:
    """Little-endian bytes of 64 bits, each set where over half of the hashes have it."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little")


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint of the text as a signed 64-bit number.

    A text of fewer words than a shingle is one shingle; one without words, or null, has zero.
    """

    def hashed(batch: pa.RecordBatch):
        texts = batch.column("_text").cast(pa.binary())
        prints = np.concatenate([majority(shingle_hashes(text.as_py(), shingle)) for text in texts]).view("<i8")
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(prints)], [*keep, "fp"])

    source = docs.select(*keep, text_column().alias("_text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return map_batches(source, hashed, f"{fields}, fp bigint")


def _bits(fp: str, first: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _keys(fp: str) -> Column:
    """The six chain keys: ring start, its segment, and one half of the segment after it."""
    keys = []
    for i, (first, width) in enumerate(SEGMENTS):
        after, span = SEGMENTS[(i + 1) % len(SEGMENTS)]
        low = span // 2
        for half, (at, n) in enumerate(((after, low), (after + low, span - low))):
            tag = F.lit((2 * i + half) << 48).cast("bigint")
            keys.append(tag.bitwiseOR(F.shiftleft(_bits(fp, first, width), 11)).bitwiseOR(_bits(fp, at, n)))
    return F.array(*keys)


def _chain(a: str, b: str, limit: int) -> Column:
    """Whether some ring start keeps every chain within its share of ``limit`` differences."""
    m = len(SEGMENTS)
    fits = F.lit(False)
    for i in range(m):
        total, within = F.lit(0), F.lit(True)
        for length in range(1, m + 1):
            first, width = SEGMENTS[(i + length - 1) % m]
            total = total + F.bit_count(_bits(a, first, width).bitwiseXOR(_bits(b, first, width)))
            within = within & (total <= length * limit // m)
        fits = fits | within
    return fits


def links(prints: DataFrame, limit: int = 2) -> DataFrame:
    """``a, b`` that join all distinct 64-bit values of ``fp`` that differ in at most ``limit`` (0 or 2) bits.

    Small buckets give every such pair; members of large ones are tied to one of their neighbours, so
    both give the same components as all pairs would.
    """
    if limit not in (0, 2):
        raise ValueError("the ring of three segments serves two differing bits, or none")
    members = written(prints.select("fp").distinct().select("fp", F.explode(_keys("fp")).alias("key")), "members")
    sizes = members.groupBy("key").agg(F.count("fp").alias("n")).where("n > 1")
    kept = members.join(sizes, "key")
    small = kept.where(F.col("n") <= BUCKET)
    one, two = (small.select("key", F.col("fp").alias(name)) for name in "ab")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= limit
    pairs = one.join(two, "key").where(F.col("a") < F.col("b")).where(_chain("a", "b", limit)).where(near)
    if not limit:
        return pairs.select("a", "b")
    hot = kept.where(F.col("n") > BUCKET).select("fp").distinct()
    flips = [F.lit(0).cast("bigint"), *(F.shiftleft(F.lit(1).cast("bigint"), i) for i in range(64))]
    near_values = written(
        hot.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(x) for x in flips))).alias("value")), "values"
    )
    least = near_values.groupBy("value").agg(F.min("fp").alias("b"), F.count("fp").alias("n")).where("n > 1")
    shared = near_values.join(least, "value").select(F.col("fp").alias("a"), "b").where("a <> b")
    return pairs.select("a", "b").union(shared).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    The component is the smallest ``doc_id`` that is reached over fingerprints that differ in at most
    ``limit`` bits; it is null only where every document reached has a null ``doc_id``. Null texts are
    empty, and empty ones have fingerprint zero, which links like any other. Rows that repeat get
    equal rows; an empty table gives none; further columns are ignored.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = written(fingerprints(source, ["doc_id"], shingle), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(prints, limit))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """The rows and columns of ``docs`` without near-duplicates: of each component of ``near_duplicates``
    the row with the smallest ``doc_id``.

    Rows without an id stand after all others, rows with one id are ordered by a hash of the text, and
    of rows equal in both one stays. Texts without words have fingerprint zero, which links like any
    other. A null text is empty. An empty table gives no rows.
    """
    hidden, inner = masked(docs)
    key, text = F.col(inner["doc_id"]).cast("bigint"), F.col(inner["text"])
    keyed = hidden.withColumn("_row", F.xxhash64(key, text))
    small = keyed.select(key.alias("doc_id"), "_row", text.alias("text"))
    prints = written(fingerprints(small, ["doc_id", "_row"], shingle), "fingerprints")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    best = prints.groupBy("fp").agg(F.min(place).alias("best"))
    roots = components(links(prints, limit)).withColumnRenamed("node", "fp")
    best = best.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best"))
    kept = keyed.join(best.select(F.col("best._row").alias("_row")), "_row", "left_semi")
    return unmasked(kept.dropDuplicates(["_row"]), inner)
