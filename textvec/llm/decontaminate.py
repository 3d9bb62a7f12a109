"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and passages of documents are hashed TF-IDF vectors (document frequencies over all documents),
projected by a randomised SVD that is worked out over the passages of all items. Documents are read as passages of several lengths, each twice the one before, that overlap
by half; an item is compared with all passages of the shortest length that can hold it, by its cosine within the
space, against the passage's whole length and relative to what the item itself would score. The sums of the
longer passages are made of those of the shorter ones, so a word is looked up once. Passages that are too short
in the space for a cosine of ``COSINE`` with any item, by the inequality of Cauchy, are not compared.

Pairs of a passage and an item from ``COSINE`` on are candidates for paraphrases. They count after checks on the
words themselves, over the passage and some words on either side, twice the item's length and ``LENGTH`` words in
all: the longest common subsequence, the answer (an item's last line, or its last third), and the longest run
of equal words. Candidates whose words cannot make such a subsequence, in whatever order, go before.

Verbatim runs do not depend on the space: the runs of ``RUN`` words of every item (all of a shorter one) are
looked up by hash at every word of every document, and what they find is checked likewise.

The benchmark is the query set. It is taken in blocks of at most ``ITEM_BLOCK`` items and ``ITEM_BYTES`` of text,
so that what all tasks get is bounded; each block reads the documents once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, masked, text_column, unmasked
from textvec.llm.latent import (
    document_frequencies,
    hashed,
    in_tasks,
    inverse_frequencies,
    numbered,
    projection,
    summed,
)
from textvec.workspace import written

N_TERMS, RANK = 1 << 15, 128
LENGTH = 24  # words of a passage of an item, and of what is checked beside twice the item's length
BASE = 4  # words; the shortest passages of documents are twice as long, and begin so far apart
PIECE = 1 << 15  # words that are searched at a time
ITEM_BLOCK, ITEM_BYTES = 10_000, 1 << 24
COSINE = 0.3
SUBSEQUENCE, ANSWER, RUN = 0.6, 0.5, 13
BLOCK_BYTES = 1 << 21

HITS = "item_id bigint, item_words int, shared int, answer_words int, answer_shared int, longest_run int"
HIT_NAMES = [field.split()[0] for field in HITS.split(", ")]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def subsequence(pattern: list, text: list) -> int:
    """Length of the longest common subsequence; one addition of whole numbers per word of ``text``."""
    masks: dict = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(pattern)) - 1
    row = full
    for word in text:
        if mask := masks.get(word):
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return len(pattern) - row.bit_count()


def longest_run(pattern: list, text: list) -> int:
    """Length of the longest run of words that both have."""
    places: dict = {}
    for i, word in enumerate(pattern):
        places.setdefault(word, []).append(i)
    best, before = 0, {}
    for word in text:
        now = {i: before.get(i - 1, 0) + 1 for i in places.get(word, ())}
        best = max(best, *now.values()) if now else best
        before = now
    return best


@dataclass
class Item:
    item_id: int
    words: list
    answer: list
    copies: int = 1  # rows that the benchmark has of it

    @property
    def least(self) -> int:
        """How many words a common subsequence has at least."""
        return math.ceil(SUBSEQUENCE * len(self.words))

    @classmethod
    def of(cls, item_id: int, text: bytes, copies: int = 1) -> Item:
        words = words_of(text)
        last = [words_of(line) for line in text.split(b"\n") if line.split()]
        answer = last[-1] if len(last) > 1 else words[-(-2 * len(words) // 3) :]
        return cls(item_id, words, answer, copies)

    def check(self, region: list) -> tuple | None:
        """The counts of a hit, if the words of ``region`` hold the item."""
        shared = subsequence(self.words, region)
        if shared < min(self.least, RUN):  # no run is longer
            return None
        run = longest_run(self.words, region)
        answer = subsequence(self.answer, region)
        verbatim = run >= min(RUN, len(self.words))
        paraphrase = shared >= self.least and answer >= ANSWER * len(self.answer)
        if not (verbatim or paraphrase):
            return None
        return self.item_id, len(self.words), shared, len(self.answer), answer, run


def _blocks(texts: pa.Array):
    rows, size, first = [], 0, 0
    for i, text in enumerate(texts.cast(pa.binary())):
        rows.append(text.as_py() or b"")
        size += len(rows[-1])
        if size >= BLOCK_BYTES:
            yield first, rows
            rows, size, first = [], 0, i + 1
    if rows:
        yield first, rows


def _terms(batch: pa.RecordBatch):
    for _, texts in _blocks(batch.column("text")):
        at, counts, words = numbered([words_of(t) for t in texts])
        yield hashed(words, N_TERMS)[at], counts


def passages(counts: np.ndarray, length: int, overlap: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last word of every passage of ``length``; none crosses a document."""
    overlap = length // 2 if overlap is None else overlap
    step = length - overlap
    ends = np.cumsum(counts)
    number = np.where(counts > 0, np.maximum(1, -(-(counts - overlap) // step)), 0)
    first = np.repeat(ends - counts, number)
    starts = first + _within(number) * step
    return starts, np.minimum(starts + length, np.repeat(ends, number))


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on for each of the counts."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _portions(sizes: np.ndarray, limit: int):
    """Slices of consecutive sizes whose sum stays within ``limit``, or of a single size."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        before = int(ends[low] - sizes[low])
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(low, high)
        low = high


class Search:
    """Items of one block with all that a task needs to find them."""

    def __init__(self, items: list[Item], table: np.ndarray, idf: np.ndarray):
        self.items, self.idf = items, idf
        at, counts, words = numbered([item.words for item in items])
        self.vocabulary = {word: i for i, word in enumerate(words)}
        terms = hashed(words, N_TERMS)
        self.table = table[terms]
        inside = summed(self.table[at], counts)
        length = np.sqrt(summed(idf[terms][at][:, None].astype(np.float64) ** 2, counts))
        own = (inside.astype(np.float64) ** 2).sum(axis=1, keepdims=True)
        # scaled so that a passage equal to an item scores one, however much of the item the space holds
        self.queries = (inside * length / np.where(own > 0, own, np.inf)).astype(np.float32)
        self.query_lengths = np.linalg.norm(self.queries, axis=1)
        self.mixed = np.random.default_rng(11).integers(1 << 63, size=len(words), dtype=np.uint64)
        self.runs = self._runs(at, counts)
        # by the length of the passages that it is compared with, the items; the shortest length that holds an item
        level = np.maximum(0, np.ceil(np.log2(np.maximum(counts, 1) / (2 * BASE)))).astype(np.int64)
        self.levels = [np.flatnonzero(level == j) for j in range(level.max(initial=-1) + 1)]
        self.lengths, self.least = counts, np.array([item.least for item in items], np.int64)
        self.margins = np.maximum(0, -(-(LENGTH + 2 * counts - (2 * BASE << level)) // 2))
        # how often each item has each of its words
        self.owned, self.own_counts = np.unique(np.repeat(np.arange(len(items)), counts) * len(words) + at, return_counts=True)

    def _runs(self, at: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By length, the sorted hashes of the runs that make an item a hit, and the item of each."""
        sizes, ends, out = np.minimum(counts, RUN), np.cumsum(counts), {}
        for size in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == size)
            number = counts[mine] - size + 1
            nth = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            hashes = self._hashes(at, np.repeat(ends[mine] - counts[mine], number) + nth, size)
            order = np.argsort(hashes, kind="stable")
            out[size] = hashes[order], np.repeat(mine, number)[order]
        return out

    def _hashes(self, codes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each place on."""
        total = np.zeros(len(places), np.uint64)
        for k in range(size):
            total = total * np.uint64(0x9E3779B97F4A7C15) + self.mixed[codes[places + k]]
        return total

    def copies(self, codes: np.ndarray, before: np.ndarray, counts: np.ndarray):
        """``place, size, item`` wherever the words have a run that makes an item a hit."""
        stop = np.repeat(np.cumsum(counts), counts)
        for size, (hashes, owners) in self.runs.items():
            places = np.arange(len(codes) - size + 1)
            places = places[(before[size:] - before[: len(places)] == size) & (places + size <= stop[: len(places)])]
            found = self._hashes(codes, places, size)
            low, high = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            for i in np.flatnonzero(high > low).tolist():
                for item in owners[low[i] : high[i]].tolist():
                    yield int(places[i]), size, item

    def candidates(self, codes: np.ndarray, weights: np.ndarray, counts: np.ndarray):
        """``first, last, item`` of all passages and items whose cosine is ``COSINE`` or more.

        ``weights`` are the squared weights of the words. Long documents are searched in pieces that overlap
        by the longest passage.
        """
        longest = 2 * BASE << max(0, len(self.levels) - 1)
        starts, stops = passages(counts, max(PIECE, 4 * longest), longest)
        for part in _portions(stops - starts, PIECE):
            first, size = starts[part], (stops - starts)[part]
            blocks = -(-size // BASE)
            begins, end = np.repeat(first, blocks) + _within(blocks) * BASE, np.repeat(first + size, blocks)
            sums, total = np.zeros((len(begins), self.table.shape[1]), np.float32), np.zeros(len(begins))
            for place in (begins + k for k in range(BASE)):
                inside = np.flatnonzero(place < end)
                total[inside] += weights[place[inside]]
                known = inside[codes[place[inside]] >= 0]
                sums[known] += self.table[codes[place[known]]]
            width = BASE
            for items in self.levels:
                if len(items):
                    at, other = self._pairs_of(blocks)
                    rows, columns = self._compared(sums, total, at, other, items)
                    owner = np.repeat(np.arange(len(size)), np.maximum(1, blocks - 1))[rows]
                    nth = at[rows] - (np.cumsum(blocks) - blocks)[owner]
                    low = first[owner] + nth * width
                    yield low, np.minimum(low + 2 * width, (first + size)[owner]), items[columns]
                blocks, width, sums, total = self._doubled(blocks, width, sums, total)

    @staticmethod
    def _pairs_of(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two blocks of every passage; the second is -1 where a piece has a single one."""
        number = np.maximum(1, blocks - 1)
        at = np.repeat(np.cumsum(blocks) - blocks, number) + _within(number)
        return at, np.where(np.repeat(blocks, number) > 1, at + 1, -1)

    @staticmethod
    def _doubled(blocks: np.ndarray, width: int, sums: np.ndarray, total: np.ndarray):
        """Every two blocks of a piece as one."""
        half = -(-blocks // 2)
        nth = _within(half)
        one = np.repeat(np.cumsum(blocks) - blocks, half) + 2 * nth
        both = np.flatnonzero(2 * nth + 1 < np.repeat(blocks, half))
        out, weight = sums[one], total[one]
        out[both] += sums[one[both] + 1]
        weight[both] += total[one[both] + 1]
        return half, 2 * width, out, weight

    def _compared(self, sums, total, at: np.ndarray, other: np.ndarray, items: np.ndarray):
        """Numbers of passages and of ``items`` with a cosine of ``COSINE`` or more."""
        queries, longest = self.queries[items].T, self.query_lengths[items].max()
        rows, columns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for low in range(0, len(at), 4096):
            one, two = at[low : low + 4096], other[low : low + 4096]
            inside, norm, some = sums[one], total[one], np.flatnonzero(two >= 0)
            inside[some] += sums[two[some]]
            norm[some] += total[two[some]]
            norm = np.sqrt(np.maximum(norm, 1e-12)).astype(np.float32)
            near = np.flatnonzero(np.sqrt(np.einsum("ij,ij->i", inside, inside)) * longest >= COSINE * (1 - 1e-5) * norm)
            row, column = np.nonzero(inside[near] @ queries >= COSINE * norm[near][:, None])
            rows.append(near[row] + low)
            columns.append(column)
        return np.concatenate(rows), np.concatenate(columns)

    def able(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Whether the words from ``low`` to ``high`` can make a subsequence that suffices, in whatever order."""
        n_words = len(self.vocabulary)
        out = np.zeros(len(items), bool)
        for part in _portions(high - low, 1 << 17):
            size, owner = (high - low)[part], items[part]
            word = codes[np.repeat(low[part], size) + _within(size)]
            known = np.flatnonzero(word >= 0)
            candidate = np.repeat(np.arange(len(size)), size)[known]
            pair = owner[candidate] * n_words + word[known]
            at = np.minimum(np.searchsorted(self.owned, pair), len(self.owned) - 1)
            has = np.flatnonzero(self.owned[at] == pair)
            key, times = np.unique(candidate[has] * len(self.owned) + at[has], return_counts=True)
            shared = np.minimum(times, self.own_counts[key % len(self.owned)])
            most = np.bincount(key // len(self.owned), weights=shared, minlength=len(size))
            out[part] = most >= self.least[owner]
        return out

    def hits(self, texts: list[bytes]) -> list[tuple[int, tuple]]:
        split = [words_of(t) for t in texts]
        at, counts, words = numbered(split)
        if not len(at) or not self.items:
            return []
        weight = self.idf[hashed(words, N_TERMS)].astype(np.float64) ** 2
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))[at]
        before = np.concatenate([[0], np.cumsum(codes >= 0)])
        ends = np.cumsum(counts)
        found: dict[tuple[int, int], tuple] = {}

        for first, last, items in self.candidates(codes, weight[at], counts):
            docs = np.searchsorted(ends, first, "right")
            low = np.maximum((ends - counts)[docs], first - self.margins[items])
            high = np.minimum(ends[docs], last + self.margins[items])
            # words of any item that are too few for this one need not be looked at
            enough = np.flatnonzero(before[high] - before[low] >= self.least[items])
            docs, low, high, items = docs[enough], low[enough], high[enough], items[enough]
            for i in np.flatnonzero(self.able(codes, low, high, items)).tolist():
                doc, column = int(docs[i]), int(items[i])
                begin = int(ends[doc] - counts[doc])
                hit = self.items[column].check(split[doc][low[i] - begin : high[i] - begin])
                if hit:  # the best of all passages
                    found[doc, column] = max(hit, found.get((doc, column), hit))
        for place, size, column in self.copies(codes, before, counts):
            doc = int(np.searchsorted(ends, place, "right"))
            if (doc, column) not in found:
                item, begin = self.items[column], int(ends[doc] - counts[doc])
                around = split[doc][max(0, place - begin - len(item.words)) : place - begin + size + len(item.words)]
                if hit := item.check(around):
                    found[doc, column] = hit
        return sorted((doc, hit) for (doc, column), hit in found.items() for _ in range(self.items[column].copies))


def _searches(docs: DataFrame, benchmark: DataFrame):
    """One search per block of items; the projection is the same for all."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
    frequencies, total = document_frequencies(texts.select("text"), _terms, N_TERMS)
    idf = inverse_frequencies(frequencies, total)
    queries = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_column().alias("text"))

    def sparse(batch: pa.RecordBatch):
        for _, part in _blocks(batch.column("text")):
            at, counts, words = numbered([words_of(t) for t in part])
            terms = hashed(words, N_TERMS)[at]
            starts, stops = passages(counts, LENGTH)
            size = stops - starts
            places = np.arange(size.sum()) + np.repeat(starts - (np.cumsum(size) - size), size)
            flat = terms[places]
            weight = idf[flat].astype(np.float64)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            norm = np.sqrt(np.add.reduceat(weight**2, offsets[:-1])) if len(weight) else np.zeros(0)
            weight /= np.repeat(np.where(norm > 0, norm, 1), size)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, flat.astype(np.int32)), pa.ListArray.from_arrays(offsets, weight)],
                ["terms", "weights"],
            )

    rows = written(map_batches(queries.select("text"), sparse, "terms array<int>, weights array<double>"), "passages")
    table = projection(in_tasks(rows), N_TERMS, RANK) * idf[:, None]
    # an id may stand in many rows: blocks go by id and text, which no two rows of the groups share
    items = queries.where("item_id is not null").groupBy("item_id", "text").agg(F.count("*").alias("n"))
    items = written(items, "items")
    last = None
    while True:
        rest = items
        if last is not None:
            after = (F.col("item_id") == last["item_id"]) & (F.col("text") > last["text"])
            rest = items.where((F.col("item_id") > last["item_id"]) | after)
        ordered = rest.orderBy("item_id", "text")
        sizes = [r[0] for r in ordered.limit(ITEM_BLOCK).select(F.octet_length("text")).collect()]
        if not sizes:
            return
        portion = next(_portions(np.array(sizes), ITEM_BYTES))
        block = ordered.limit(portion.stop).collect()
        held = [Item.of(row["item_id"], row["text"].encode(), row["n"]) for row in block]
        yield Search([item for item in held if item.words], table, idf)
        last = block[-1]


def leaks(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of a document with the item that it holds, and how much of it; a row per pair.

    Beside ``item_id``: the words of the item and of its answer, how many of each the longest common
    subsequence has, and the longest run of equal words. Null texts are empty and hold nothing, empty
    items and items without an id are held by nothing. Rows that repeat are judged alike; an empty
    table on either side gives no rows; further columns are ignored.
    """
    source = docs.select(*keep, text_column().alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    out = None
    for search in _searches(docs, benchmark):
        found = _found(source, search, keep, fields)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], f"{fields}, {HITS}") if out is None else out


def _found(source: DataFrame, search: Search, keep: tuple[str, ...], fields: str) -> DataFrame:
    held = source.sparkSession.sparkContext.broadcast(search)

    def find(batch: pa.RecordBatch):
        for first, texts in _blocks(batch.column("_text")):
            hits = held.value.hits(texts)
            rows = pa.array([first + doc for doc, _ in hits], pa.int64())
            values = list(zip(*(hit for _, hit in hits), strict=True)) or [()] * len(HIT_NAMES)
            kinds = [pa.int64()] + [pa.int32()] * (len(HIT_NAMES) - 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(rows) for c in keep), *map(pa.array, values, kinds)], [*keep, *HIT_NAMES]
            )

    return map_batches(source, find, f"{fields}, {HITS}")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; judged in place, without a join."""
    out, inner = masked(docs)
    for search in _searches(docs, benchmark):
        held = docs.sparkSession.sparkContext.broadcast(search)

        def keep(batch: pa.RecordBatch, held=held):
            for first, texts in _blocks(batch.column(inner["text"])):
                hit = np.zeros(len(texts), bool)
                hit[[doc for doc, _ in held.value.hits(texts)]] = True
                yield batch.slice(first, len(texts)).filter(pa.array(~hit))

        fields = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(out.columns, docs.schema, strict=True))
        out = map_batches(out, keep, fields)
    return unmasked(out, inner)
