"""Runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that has
``max(MIN_WORDS, MIN_REPEATS * q)`` words or more and that no neighbouring word extends. Every word of
a run therefore occurs ``MIN_REPEATS`` times or more in any segment that holds the run. So a word that
occurs less often in its segment belongs to no run there: it splits the segment. In the parts further
words become rare; this goes on until nothing splits, over all texts of a batch at once. No run is cut
by it, as a run lies in one part as a whole.

Segments that survive are scanned lag by lag. Short ones, and all small lags, by comparing the words
with the words a lag further on. In long segments and at longer lags p a run matches over 2p words or
more, so it covers a whole block of p words that begins at a multiple of p and equals the block after
it: only those are compared, by rolling hashes, n / p blocks for lag p, and n log n in all. What is
found there is verified on the words.

Everything about a text stays with the text, so the work is one pass over the table without shuffle.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, masked, text_column, unmasked

MIN_WORDS, MIN_REPEATS = 24, 3
BATCH_BYTES = 4 << 20  # texts whose words are looked at together; a longer text is alone
SCANNED_WORDS = 2048  # segments up to this length are compared directly at all lags
SCANNED_LAGS = 16  # and longer ones at these
TILE = 1 << 20  # comparisons held at a time

Run = tuple[int, int, int]  # start, length, period
Words = Callable[[object, str], list[bytes]]


def plain_words(key: object, text: str) -> list[bytes]:
    """The words of a text: maximal runs without ASCII white space."""
    return text.encode().split()


def words_with_planted_tail(key: object, text: str) -> list[bytes]:
    """The words of a text, of which every tenth document (by crc32 of its key) gets a periodic end."""
    words = text.encode().split()
    group, tenth = divmod(zlib.crc32(b"" if key is None else str(key).encode()), 10)
    if tenth or not words:
        return words
    first = group % len(words)
    rest = len(words) - first
    period = 1 + rest // (3 + group % 8)
    return words[:first] + (words[first : first + period] * -(-rest // period))[:rest]


def surviving_segments(codes: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of the segments without rare words; ``text_of`` ascends."""
    at, segment = np.arange(len(codes)), text_of.astype(np.int64)
    n_codes = int(codes.max(initial=0)) + 1
    while len(at):
        _, inverse, counts = np.unique(segment * n_codes + codes[at], return_inverse=True, return_counts=True)
        frequent = counts[inverse] >= MIN_REPEATS
        at, segment = at[frequent], segment[frequent]
        first = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0))
        sizes = np.diff(np.append(first, len(at)))
        long = sizes >= MIN_WORDS
        if frequent.all() and long.all():
            return at[first], sizes
        kept = np.repeat(long, sizes)
        at, segment = at[kept], np.repeat(np.arange(len(first)), sizes)[kept]
    return np.empty(0, np.int64), np.empty(0, np.int64)


def _scanned(words: np.ndarray, last_lag: int, found: dict[tuple[int, int], int]) -> None:
    """Add the qualifying stretches at the lags 1 to ``last_lag``, compared word by word."""
    n = len(words)
    step = max(1, TILE // (n + 1))
    for low in range(1, last_lag + 1, step):
        lags = range(low, min(low + step, last_lag + 1))
        same = np.zeros((len(lags), n + 1), dtype=np.int8)
        for row, lag in zip(same, lags, strict=True):
            row[: n - lag] = words[:-lag] == words[lag:]
        edges = np.flatnonzero(np.diff(same.ravel(), prepend=0))
        begin, end = edges[::2], edges[1::2]
        lag = low + begin // (n + 1)
        length = end - begin + lag
        for i in np.flatnonzero(length >= np.maximum(MIN_WORDS, MIN_REPEATS * lag)):
            start = int(begin[i] % (n + 1))
            found.setdefault((start, start + int(length[i])), int(lag[i]))


class _Hashes:
    """Rolling hashes of a segment: equal stretches have equal hashes, the converse is verified."""

    def __init__(self, words: np.ndarray):
        self.words = words
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.powers = np.cumprod(np.concatenate([[1], np.full(len(words), 0x100000001B3)]).astype(np.uint64))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:-1])])

    def same_blocks(self, lag: int) -> np.ndarray:
        """Beginnings of the aligned blocks of ``lag`` words that equal the block after them."""
        blocks = np.diff(self.sums[::lag])
        return np.flatnonzero(blocks[:-1] * self.powers[lag] == blocks[1:]) * lag

    def _same(self, a: int, lag: int, size: int) -> bool:
        s = self.sums
        return (s[a + size] - s[a]) * self.powers[lag] == s[a + lag + size] - s[a + lag]

    def stretch(self, at: int, lag: int) -> tuple[int, int]:
        """The stretch around ``at`` in which words ``lag`` apart are the same, its end exclusive."""
        right = _longest(lambda size: self._same(at, lag, size), len(self.words) - at - lag)
        left = _longest(lambda size: self._same(at - size, lag, size), at)
        return at - left, at + lag + right

    def verified(self, start: int, end: int, lag: int) -> bool:
        return np.array_equal(self.words[start : end - lag], self.words[start + lag : end])


def _longest(holds: Callable[[int], bool], most: int) -> int:
    """The largest size up to ``most`` for which ``holds``, which holds for all smaller ones."""
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if holds(middle) else (low, middle - 1)
    return low


def _compared(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """As ``_Hashes.stretch``, on the words."""
    differ = np.flatnonzero(words[:-lag] != words[lag:])
    i = int(np.searchsorted(differ, at))
    start = int(differ[i - 1]) + 1 if i else 0
    return start, (int(differ[i]) if i < len(differ) else len(words) - lag) + lag


def _matched_blocks(words: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Add the qualifying stretches at the lags above ``SCANNED_LAGS``."""
    first, last, period = 0, 0, 1  # the longest run so far
    with np.errstate(over="ignore"):
        hashes = _Hashes(words)
        for lag in range(SCANNED_LAGS + 1, len(words) // MIN_REPEATS + 1):
            begins = hashes.same_blocks(lag)
            i = 0
            while i < len(begins):
                at = int(begins[i])
                if first <= at and at + 2 * lag <= last and lag % period == 0:
                    start, end = first, last
                else:
                    start, end = hashes.stretch(at, lag)
                if (start, end) not in found and not hashes.verified(start, end, lag):
                    start, end = _compared(words, at, lag)
                if end - start >= max(MIN_WORDS, MIN_REPEATS * lag):
                    found.setdefault((start, end), lag)
                    if end - start > last - first:
                        first, last, period = start, end, found[start, end]
                # the next stretch begins after the word at which this one ends
                i = max(i + 1, int(np.searchsorted(begins, end - lag)))


def runs_of(words: np.ndarray) -> list[Run]:
    """The runs of one segment of word numbers. A stretch that repeats at several lags counts with
    the smallest, its period: the others are multiples of it, as it holds three of them."""
    found: dict[tuple[int, int], int] = {}
    if len(words) <= SCANNED_WORDS:
        _scanned(words, len(words) // MIN_REPEATS, found)
    else:
        _scanned(words, SCANNED_LAGS, found)
        _matched_blocks(words, found)
    return sorted((start, end - start, lag) for (start, end), lag in found.items())


def _with_runs(texts: list[list[bytes]]) -> Iterator[tuple[list[bytes], list[Run]]]:
    """The words of each text and its runs by start, then period."""
    sizes = [len(words) for words in texts]
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for words in texts for w in words), np.int64, sum(sizes))
    begins, lengths = surviving_segments(codes, np.repeat(np.arange(len(texts)), sizes))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    runs: list[list[Run]] = [[] for _ in texts]
    for text, begin, length in zip(np.searchsorted(offsets, begins, "right") - 1, begins, lengths, strict=True):
        shift = int(begin - offsets[text])
        runs[text] += [(start + shift, size, lag) for start, size, lag in runs_of(codes[begin : begin + length])]
    for words, found in zip(texts, runs, strict=True):
        yield words, sorted(found, key=lambda run: (run[0], run[2]))


def _pieces(keys: list, texts: list[str], words_of: Words) -> Iterator[tuple[list[bytes], list[Run]]]:
    held, size = [], 0
    for key, text in zip(keys, texts, strict=True):
        held.append(words_of(key, text))
        size += len(text)
        if size >= BATCH_BYTES:
            yield from _with_runs(held)
            held, size = [], 0
    if held:
        yield from _with_runs(held)


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), dtype=bool)
    for start, size, period in runs:
        kept[start + period : start + size] = False
    return [words[i] for i in np.flatnonzero(kept)]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length / period; of equal ones the first, then the shorter period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


REPORT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def report(docs: DataFrame, words_of: Words = plain_words) -> DataFrame:
    """One row per document: number of runs, the strongest one, digests of all runs and of the words kept.

    A null text has no words; a null ``doc_id`` stays null and its rows are kept, as are repeated rows,
    row by row. A text without runs has four nulls and the digest of the empty list. Further columns of
    ``docs`` are ignored; an empty table gives no rows. Texts are taken whole, whatever their length.
    """

    def digest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts = (column.to_pylist() for column in batch.columns)
        rows = []
        for key, (words, runs) in zip(keys, _pieces(keys, texts, words_of), strict=True):
            best = strongest(runs)
            told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
            listed = "".join(f"{start},{size},{period}\n" for start, size, period in runs)
            left = hashlib.sha256(b" ".join(without_repeats(words, runs))).hexdigest()
            rows.append((key, len(runs), *told, hashlib.sha256(listed.encode()).hexdigest(), left))
        names = [field.split()[0] for field in REPORT.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] * 2
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(_source(docs), digest, REPORT)


def found_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, start, length, period, unit``: every run of every document, with the words of one
    period. Documents without runs give no rows; odd cases as in ``report``."""

    def rows_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, texts = (column.to_pylist() for column in batch.columns)
        rows = [
            (key, *run, b" ".join(words[run[0] : run[0] + run[2]]).decode())
            for key, (words, runs) in zip(keys, _pieces(keys, texts, plain_words), strict=True)
            for run in runs
        ]
        kinds = [pa.int64()] * 4 + [pa.string()]
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "period", "unit"])

    return map_batches(_source(docs), rows_of, "doc_id bigint, start bigint, length bigint, period bigint, unit string")


def collapsed(docs: DataFrame) -> DataFrame:
    """``docs`` with every run cut to its first period. Texts without runs, null ones included, stay as
    they are; in others the words kept are joined by one space. All columns and rows are kept."""
    hidden, inner = masked(docs)
    text = list(hidden.columns).index(inner["text"])

    def rewrite(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        old = batch.column(text).to_pylist()
        found = _pieces(old, [t or "" for t in old], plain_words)
        new = [
            b" ".join(without_repeats(words, runs)).decode() if runs else was
            for was, (words, runs) in zip(old, found, strict=True)
        ]
        columns = list(batch.columns)
        columns[text] = pa.array(new, batch.schema.field(text).type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return unmasked(map_batches(hidden, rewrite, hidden.schema), inner)


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
