"""Removal of repeated text by prefix-free parsing.

A rolling hash runs over all 26-byte strings of a document. In every 50-byte window the string with the
smallest hash is the window's trigger, so equal windows have equal triggers wherever they stand.
Consecutive windows with one trigger form a phrase: the text from the first window's start to the last
one's end. Phrases overlap by 49 bytes, every window lies in exactly one, and a document's sequence of
phrases is its parse. The dictionary of distinct phrases is all that has to be ordered:

* A trigger with one phrase in the whole dictionary puts all its windows in the order of that
  phrase, so the first document that has the phrase has each of the windows first.
* Where a trigger has several phrases, their suffixes of 50 bytes are put together one by one.

Instead of one suffix array in one place, equal suffixes meet by their 64-bit rolling hash, which is
the part of corpus order that the question needs: the first document of each group of equal suffixes.

Documents meet in chunks (:mod:`textvec.llm.chunks`); a chunk asks twice about its distinct keys, first
whether other documents have a trigger and with which phrase, then for the first document of the
phrases and windows in question. Each chunk sends a key once, so a passage that a third of all documents
have is one entry per chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.chunks import dealt, each_chunk, with_answers
from textvec.llm.common import text_column, total_bytes
from textvec.workspace import written

WINDOW, GRAM = 50, 26
CHUNK_BYTES = 1 << 25
BLOCK_BYTES = 1 << 20
LAST = (1 << 63) - 1  # documents without an id come after all others
MULTIPLIER = 0x9E3779B97F4A7C15 | 1

RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
BLOBS = "chunk bigint, bucket bigint, keys binary, marks binary"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2^64."""
    up = np.full(n, np.uint64(MULTIPLIER))
    down = np.full(n, np.uint64(pow(MULTIPLIER, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Parse:
    """The phrases of some documents laid end to end."""

    values = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULTIPLIER))

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes)
        self.first = self.ends - sizes
        n = int(self.ends[-1]) if len(texts) else 0
        data = np.frombuffer(b"".join(texts), np.uint8)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * up[:n], out=self.sums[1:])
        # starts of windows that end within their document
        number = np.maximum(sizes - WINDOW + 1, 0)
        nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        self.window = np.repeat(self.first, number) + nth
        self.window_doc = np.repeat(np.arange(len(texts)), number)
        low = self.hashes(np.arange(max(0, n - GRAM + 1)), GRAM)
        reach, width = 1, WINDOW - GRAM + 1
        while reach * 2 <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width and len(low):
            low = np.minimum(low[: -(width - reach)], low[width - reach :])
        trigger = low[self.window] if len(self.window) else np.zeros(0, np.uint64)
        new = np.ones(len(trigger), bool)
        new[1:] = (trigger[1:] != trigger[:-1]) | (self.window_doc[1:] != self.window_doc[:-1])
        at = np.flatnonzero(new)
        self.count = np.diff(np.append(at, len(trigger)))  # windows per phrase
        self.start = self.window[at]
        self.doc = self.window_doc[at]
        self.trigger = trigger[at]
        size = self.count + WINDOW - 1
        self.phrase = _mixed(self.hashes(self.start, size) + size.astype(np.uint64) * np.uint64(MULTIPLIER))

    def hashes(self, starts: np.ndarray, size) -> np.ndarray:
        return _mixed((self.sums[starts + size] - self.sums[starts]) * self.down[starts])

    def windows(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows of the chosen phrases, and the phrase of each."""
        count = self.count[phrases]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.start[phrases], count) + nth, np.repeat(phrases, count)


def _texts(batches):
    """Ids and texts of a chunk in blocks of about ``BLOCK_BYTES``."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            ids.append(LAST if key is None else key)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield np.array(ids, np.int64), texts
                ids, texts, size = [], [], 0
    if texts:
        yield np.array(ids, np.int64), texts


def _runs(keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal sorted keys."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def _blobs(chunk: int, bucket: np.ndarray, keys: np.ndarray, marks: np.ndarray) -> pa.Table:
    """One row per bucket; keys stay in order within it."""
    order = np.argsort(bucket, kind="stable")
    bucket, keys, marks = bucket[order], keys[order], marks[order]
    at = _runs(bucket)
    ends = np.append(at, len(bucket))[1:]
    rows = [(chunk, int(bucket[a]), keys[a:b].tobytes(), marks[a:b].tobytes()) for a, b in zip(at, ends, strict=True)]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "bucket", "keys", "marks"])


def _gathered(table: pa.Table, key: type, mark: type):
    """All entries of a bucket: the chunk, key and mark of each."""
    keys = [np.frombuffer(b.as_buffer(), key) for b in table.column("keys")]
    marks = [np.frombuffer(b.as_buffer(), mark) for b in table.column("marks")]
    chunk = np.repeat(table.column("chunk").to_numpy(), [len(k) for k in keys])
    return chunk, np.concatenate(keys), np.concatenate(marks)


# a trigger within its bucket: 32 bits of it, 32 bits of its phrase, whether the chunk has it in more than one document
# and in more than one phrase
TRIGGER = np.dtype([("phrase", "<u4"), ("documents", "?"), ("phrases", "?")])


def _ask_triggers(buckets: int):
    def ask(chunk: int, batches) -> pa.Table:
        parts = []
        for ids, texts in _texts(batches):
            p = Parse(texts)
            parts.append((p.trigger, p.phrase, ids[p.doc]))
        trigger, phrase, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((phrase, trigger))
        trigger, phrase, doc = trigger[order], phrase[order], doc[order]
        at = _runs(trigger)
        marks = np.zeros(len(at), TRIGGER)
        if len(at):
            marks["phrase"] = phrase[at] >> np.uint64(32)
            marks["documents"] = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
            marks["phrases"] = np.minimum.reduceat(phrase, at) < np.maximum.reduceat(phrase, at)
        keys = trigger[at]
        return _blobs(chunk, (keys % np.uint64(buckets)).astype(np.int64), (keys >> np.uint64(32)).astype("<u4"), marks)

    return ask


def _tell_triggers(key: tuple, table: pa.Table) -> pa.Table:
    """To every chunk those of its triggers that more documents have; marked where they have several phrases."""
    chunk, keys, marks = _gathered(table, np.dtype("<u4"), TRIGGER)
    order = np.argsort(keys, kind="stable")
    chunk, keys, marks = chunk[order], keys[order], marks[order]
    at = _runs(keys)
    size = np.diff(np.append(at, len(keys)))
    phrase = marks["phrase"]
    shared = (size > 1) | np.logical_or.reduceat(marks["documents"], at)
    several = np.logical_or.reduceat(marks["phrases"], at)
    several |= np.minimum.reduceat(phrase, at) < np.maximum.reduceat(phrase, at)
    shared, several = np.repeat(shared, size), np.repeat(several, size)
    return _replies(key, chunk[shared], keys[shared], several[shared])


def _replies(key: tuple, chunk: np.ndarray, keys: np.ndarray, marks: np.ndarray) -> pa.Table:
    order = np.argsort(chunk, kind="stable")
    chunk, keys, marks = chunk[order], keys[order], marks[order]
    at = _runs(chunk)
    ends = np.append(at, len(chunk))[1:]
    rows = [
        (int(chunk[a]), key[0].as_py(), keys[a:b].tobytes(), marks[a:b].tobytes()) for a, b in zip(at, ends, strict=True)
    ]
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "bucket", "keys", "marks"])


def _classes(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``bucket, 32 bits`` of the shared triggers, and whether each has several phrases."""
    keys, marks = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for bucket, k, m in zip(
        answers.column("bucket").to_pylist(), answers.column("keys"), answers.column("marks"), strict=True
    ):
        keys.append(np.frombuffer(k.as_buffer(), "<u4").astype(np.uint64) | np.uint64(bucket << 32))
        marks.append(np.frombuffer(m.as_buffer(), bool))
    keys, marks = np.concatenate(keys), np.concatenate(marks)
    order = np.argsort(keys)
    return keys[order], marks[order]


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is, and whether it is there at all."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _questions(p: Parse, keys: np.ndarray, several: np.ndarray, buckets: int):
    """What has to be asked about a parse: shared phrases whole, and windows of triggers with several phrases.

    The last bit of a key tells the two apart. Returned are keys, starts and ends of the bytes each
    stands for, and documents.
    """
    own = ((p.trigger % np.uint64(buckets)) << np.uint64(32)) | (p.trigger >> np.uint64(32))
    at, there = _found(keys, own)
    split = there & several[at] if len(keys) else there
    whole = np.flatnonzero(there & ~split)
    start, phrase = p.windows(np.flatnonzero(split))
    return (
        np.concatenate([p.phrase[whole] | np.uint64(1), p.hashes(start, WINDOW) & ~np.uint64(1)]),
        np.concatenate([p.start[whole], start]),
        np.concatenate([p.start[whole] + p.count[whole] + WINDOW - 1, start + WINDOW]),
        np.concatenate([p.doc[whole], p.doc[phrase]]),
    )


SPAN = np.dtype([("first", "<i8"), ("last", "<i8")])


def _ask_first(buckets: int):
    def ask(batches, answers: pa.Table) -> pa.Table:
        shared, several = _classes(answers)
        parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for ids, texts in _texts(batches):
            keys, _, _, doc = _questions(Parse(texts), shared, several, buckets)
            parts.append((keys, ids[doc]))
        keys, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, doc = keys[order], doc[order]
        at = _runs(keys)
        marks = np.zeros(len(at), SPAN)
        if len(at):
            marks["first"], marks["last"] = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
        keys = keys[at]
        chunk = answers.column("chunk")[0].as_py() if len(answers) else -1
        return _blobs(chunk, ((keys >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64), keys, marks)

    return ask


def _tell_first(key: tuple, table: pa.Table) -> pa.Table:
    """To every chunk the first document of each of its keys, where one of its documents comes later."""
    chunk, keys, marks = _gathered(table, np.dtype("<u8"), SPAN)
    order = np.argsort(keys, kind="stable")
    chunk, keys, marks = chunk[order], keys[order], marks[order]
    at = _runs(keys)
    first = np.repeat(np.minimum.reduceat(marks["first"], at), np.diff(np.append(at, len(keys))))
    later = first < marks["last"]
    return _replies(key, chunk[later], keys[later], first[later])


def _cut(buckets: int):
    def cut(batches, answers: pa.Table) -> pa.Table:
        kinds = answers.column("kind").to_numpy()
        shared, several = _classes(answers.filter(pa.array(kinds == 0)))
        told = answers.filter(pa.array(kinds == 1))
        keys = np.concatenate([np.zeros(0, "<u8"), *(np.frombuffer(b.as_buffer(), "<u8") for b in told.column("keys"))])
        first = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(b.as_buffer(), "<i8") for b in told.column("marks"))])
        order = np.argsort(keys)
        keys, first = keys[order], first[order]
        rows = []
        for ids, texts in _texts(batches):
            p = Parse(texts)
            asked, start, end, doc = _questions(p, shared, several, buckets)
            at, there = _found(keys, asked)
            gone = there & (first[at] < ids[doc]) if len(keys) else there
            n = int(p.ends[-1])
            steps = np.bincount(start[gone], minlength=n + 1) - np.bincount(end[gone], minlength=n + 1)
            covered = np.cumsum(steps)[:n] > 0
            for i, text in enumerate(texts):
                mask = covered[p.first[i] : p.ends[i]]
                removed = int(mask.sum())
                kept = text if not removed else np.frombuffer(text, np.uint8)[~mask].tobytes()
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed else 0
                key = None if ids[i] == LAST else int(ids[i])
                rows.append((key, len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
        kinds = (pa.int64(),) * 4 + (pa.string(),)
        columns = list(zip(*rows, strict=True)) or [()] * 5
        names = [field.split()[0] for field in RESULT.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return cut


def without_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte goes when a 50-byte string that covers it also starts in a document with a smaller ``doc_id``.
    A null text is empty; texts under 50 bytes lose nothing. Documents without an id come after all
    others, and lose nothing to one another; nor do rows with one id. An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
    buckets = max(8, 2 * -(-total_bytes(source) // chunk_bytes))
    parts = dealt(source, "doc_id", "text", chunk_bytes)
    triggers = each_chunk(parts, _ask_triggers(buckets), BLOBS)
    shared = written(triggers.groupBy("bucket").applyInArrow(_tell_triggers, BLOBS), "triggers")
    asked = with_answers(parts, shared, _ask_first(buckets), BLOBS).where("chunk >= 0")
    first = asked.groupBy("bucket").applyInArrow(_tell_first, BLOBS)
    answers = shared.select("*", F.lit(0).alias("kind")).unionByName(first.select("*", F.lit(1).alias("kind")))
    return with_answers(parts, answers, _cut(buckets), RESULT)
