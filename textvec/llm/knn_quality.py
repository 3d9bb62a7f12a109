"""Quality by the votes of similar labelled documents in a latent-semantic space.

A text's terms are its words, the shapes of its words (letters, capitals and digits collapsed, marks
kept), a mark for every word that repeats the one before, and its length. Document frequencies cover
all documents. The space and the voters come from a bounded sample of labelled documents (``SAMPLE``
of them at most, the first by a hash of their id), whose vectors go to all tasks: ``SAMPLE x RANK``
numbers, whatever the corpus. Every document is compared with every voter by exact cosines, one block
of documents at a time; its ``NEIGHBOURS`` nearest voters vote with their similarity to the power
``SHARPNESS``. Cosines are rounded to ``1 / STEPS``, and of equal ones the voter with the smaller id is nearer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textvec.llm.common import crc32_remainder, map_batches, text_column
from textvec.llm.latent import (
    document_frequencies,
    hashed,
    inverse_frequencies,
    numbered,
    projection,
    summed_picks,
    unit,
)
from textvec.workspace import written

SHAPES, WORDS = 1 << 12, 1 << 15
N_TERMS = SHAPES + WORDS
REPEAT, LENGTHS, FIRST_SHAPE = 0, 1, 64  # term numbers of the repeat mark, of lengths, of shapes
SHAPE_WEIGHT = np.float32(2.0)
SAMPLE, RANK = 8192, 32
NEIGHBOURS, SHARPNESS, STEPS = 15, 4, 1 << 16
THRESHOLD = 0.3
BLOCK_BYTES = 1 << 20

SCORES = "doc_id bigint, held_out boolean, score double, predicted int"


def shape(word: bytes) -> bytes:
    out: list[str] = []
    for c in word.decode("utf-8", "replace"):
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out).encode()


def _terms(texts: list[bytes]):
    """Per distinct word its two terms; per word its number; per text its words, repeats and length term."""
    at, counts, words = numbered([t.split() for t in texts])
    word_terms = SHAPES + hashed((w.lower() for w in words), WORDS)
    shape_terms = FIRST_SHAPE + hashed(map(shape, words), SHAPES - FIRST_SHAPE, 1)
    doc = np.repeat(np.arange(len(texts)), counts)
    again = doc[1:][(at[1:] == at[:-1]) & (doc[1:] == doc[:-1])]
    repeats = np.bincount(again, minlength=len(texts))
    length = LENGTHS + np.minimum(FIRST_SHAPE - 2, (2 * np.log2(counts + 1)).astype(np.int64))
    return word_terms, shape_terms, at, counts, repeats, length


def _blocks(batch: pa.RecordBatch, column: str = "text"):
    """The batch in blocks of about ``BLOCK_BYTES`` of text: first row and the texts as bytes, a null as empty."""
    texts, size, first = [], 0, 0
    for i, text in enumerate(batch.column(column).cast(pa.binary())):
        texts.append(text.as_py() or b"")
        size += len(texts[-1])
        if size >= BLOCK_BYTES:
            yield first, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, texts


def _sparse(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted ``document * N_TERMS + term`` with the number of times, and the documents' sizes in it."""
    word_terms, shape_terms, at, counts, repeats, length = _terms(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    every = np.arange(len(texts))
    keys = np.concatenate([doc * N_TERMS + word_terms[at], doc * N_TERMS + shape_terms[at], every * N_TERMS + length])
    found, times = np.unique(keys, return_counts=True)
    marked = np.flatnonzero(repeats)
    found = np.concatenate([found, marked * N_TERMS + REPEAT])
    times = np.concatenate([times, repeats[marked]])
    order = np.argsort(found)
    found, times = found[order], times[order]
    return found, times, np.bincount(found // N_TERMS, minlength=len(texts))


def _all_terms(batch: pa.RecordBatch):
    for _, texts in _blocks(batch):
        found, _, sizes = _sparse(texts)
        yield found % N_TERMS, sizes


def _weights(idf: np.ndarray) -> np.ndarray:
    weights = idf.copy()
    weights[:SHAPES] *= SHAPE_WEIGHT
    return weights


def vectors(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """Unit latent vectors; ``table`` is the projection with every row already weighted."""
    word_terms, shape_terms, at, counts, repeats, length = _terms(texts)
    per_word = table[word_terms] + table[shape_terms]
    total = summed_picks(per_word, at, counts)
    total += repeats[:, None] * table[REPEAT] + table[length]
    return unit(total)


def nearest(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row the columns of its ``k`` highest scores, in order; of equal scores the first columns."""
    near = np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]
    least = np.take_along_axis(scores, near, 1).min(axis=1)
    for row in np.flatnonzero((scores >= least[:, None]).sum(axis=1) > k):
        able = np.flatnonzero(scores[row] >= least[row])
        near[row] = able[np.argsort(-scores[row, able], kind="stable")[:k]]
    return np.sort(near, axis=1)


class Model:
    """What a fit leaves: the weighted projection and the voters with their labels."""

    def __init__(self, table: np.ndarray, voters: np.ndarray, labels: np.ndarray):
        self.table, self.voters, self.labels = table, voters, labels

    def scores(self, texts: list[bytes]) -> np.ndarray:
        mine = vectors(texts, self.table)
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(texts), prior)
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for low in range(0, len(texts), 512):
            cosine = mine[low : low + 512] @ self.voters.T
            cosine *= STEPS
            np.rint(cosine, out=cosine)
            near = np.concatenate([nearest(cosine[i : i + 64], k) for i in range(0, len(cosine), 64)])
            weight = np.clip(np.take_along_axis(cosine, near, 1).astype(np.float64) / STEPS, 0, 1) ** SHARPNESS
            total = weight.sum(axis=1)
            votes = (weight * self.labels[near]).sum(axis=1)
            out[low : low + 512] = np.where(total > 0, votes / np.where(total > 0, total, 1), prior)
        return out


def fit(docs: DataFrame, labels: DataFrame, held_out: Column) -> Model:
    """A model from all documents' term frequencies and a bounded sample of the labels not held out.

    ``labels`` has ``doc_id, quality``; rows with a null in either are left out, and where a document has
    several labels the least one holds, where an id has several texts the first of them in order. Labels are
    used as votes only.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
    frequencies, total = document_frequencies(texts.select("text"), _all_terms, N_TERMS)
    weights = _weights(inverse_frequencies(frequencies, total))
    known = labels.where("doc_id is not null and quality is not null").where(~held_out)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)

    def sparse(batch: pa.RecordBatch):
        for first, part in _blocks(batch):
            found, times, sizes = _sparse(part)
            terms = found % N_TERMS
            weight = times * weights[terms].astype(np.float64)
            doc = np.repeat(np.arange(len(part)), sizes)
            norm = np.sqrt(np.bincount(doc, weight * weight, len(part)))
            weight /= np.where(norm > 0, norm, 1)[doc]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(first, len(part)) for c in ("doc_id", "quality", "text")),
                    pa.ListArray.from_arrays(offsets, terms.astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, weight),
                ],
                ["doc_id", "quality", "text", "terms", "weights"],
            )

    # at most SAMPLE ids: small enough to send to all tasks
    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", F.col("quality").cast("int"), "text")
    # one row per id, so copies of a row in the documents do not grow the sample
    chosen = chosen.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("text").alias("text"))
    schema = "doc_id bigint, quality int, text string, terms array<int>, weights array<double>"
    rows = written(map_batches(chosen, sparse, schema), "sample").coalesce(8)
    table = projection(rows.select("terms", "weights"), N_TERMS, RANK) * weights[:, None]

    def voting(batch: pa.RecordBatch):
        for first, part in _blocks(batch):
            mine = vectors(part, table)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, len(part)),
                    batch.column("quality").slice(first, len(part)),
                    pa.array([v.tobytes() for v in mine], pa.binary()),
                ],
                ["doc_id", "quality", "vector"],
            )

    found = map_batches(rows.select("doc_id", "quality", "text"), voting, "doc_id bigint, quality int, vector binary")
    voters = sorted(found.collect())  # at most SAMPLE rows
    matrix = np.array([np.frombuffer(v["vector"], np.float32) for v in voters], np.float32).reshape(-1, RANK)
    return Model(table, matrix, np.array([v["quality"] for v in voters], np.float64))


def scored(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and ``score``: the share of the votes for quality 1, from 0 to 1.

    A null text is empty; an empty one is judged by its length alone. Where no neighbour has any
    similarity, and without any label, the share of label 1 among the voters (or one half) stands.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    inner = [f"_{i}" for i in range(len(keep))]
    kinds = docs.select(*keep).schema
    source = docs.select(*(F.col(c).alias(i) for c, i in zip(keep, inner, strict=True)), text_column(text).alias("text"))
    judged = "text"
    if text in keep and kinds[keep.index(text)].dataType == T.StringType():  # then it goes to Python once
        judged = inner[keep.index(text)]
        source = source.drop("text")

    def judge(batch: pa.RecordBatch):
        for first, texts in _blocks(batch, judged):
            columns = [batch.column(c).slice(first, len(texts)) for c in inner]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(held.value.scores(texts))], [*inner, "_score"])

    fields = ", ".join(f"{i} {f.dataType.simpleString()}" for i, f in zip(inner, kinds, strict=True))
    return map_batches(source, judge, f"{fields}, _score double").toDF(*keep, "score")


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows and columns of ``docs`` whose score reaches ``THRESHOLD``; judged in place."""
    names = docs.columns
    found = scored(docs, model, names).toDF(*names, "_score_of_text")
    return found.where(F.col("_score_of_text") >= THRESHOLD).select(*names)


def classified(docs: DataFrame, labels: DataFrame, divisor: int = 5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Rows whose crc32 of the id is divisible by ``divisor`` are held out of the fit (so is a null
    ``doc_id``, whose text is ''). Repeated rows are scored alike; an empty table gives no rows; further columns,
    and language and source, are never looked at.
    """
    held_out = crc32_remainder("doc_id", divisor) == 0
    model = fit(docs, labels, held_out)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), "text")
    return scored(source, model, ["doc_id", "held_out"]).select(
        "*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
