"""Sequence packing by minimum bin slack.

Documents become token ids, whole windows are cut off their front, and the remaining tails, all
shorter than a window, are packed. Only the histogram of tail lengths (at most ``window - 1``
numbers, whatever the corpus) reaches the driver. There a subset-sum table of bits finds, for the
longest tail left, the multiset of further lengths that fills the window closest to its capacity;
the pattern is applied as often as the counts allow, so the plan holds patterns, not documents.
A tail finds its place from its length and its number among the tails of that length.
"""

from __future__ import annotations

import re
import os
import unicodedata
import zlib
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.common import map_batches, text_column
from textvec.operators.totals import running_totals
from textvec.workspace import written

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"

_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class _Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class _Lists:
    """Numbered lists of token ids in two flat arrays."""

    def __init__(self):
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def extend(self, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, ids])

    def joined(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists numbered ``at`` one after the other, and where each begins and the last ends."""
        lengths = self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(ends[-1]) + np.repeat(self.starts[at] - ends[:-1], lengths)
        return self.ids[places], ends


class WordIds:
    """Token ids of white-space separated words, each distinct word encoded once.

    The tokenizer never joins characters across white space, so a text's ids are those of its
    words in order. Words of ASCII and Latin-1 letters are cut as the tokenizer's own pattern cuts
    them, and their runs are encoded many at a time; the mark that ends a run's last token tells
    them apart again. All other words go through the whole tokenizer. About ``limit`` words are
    remembered between batches.
    """

    def __init__(self, path: str, limit: int = 200_000):
        # one thread: a task has one core, and every thread would keep memory of its own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.fast = Tokenizer.from_file(path)
        self.fast.normalizer = normalizers.Sequence([])
        self.fast.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.fast.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.index, self.words = _Numbered(), _Lists()
        self.run_index, self.runs = _Numbered(), _Lists()

    def _encode_runs(self, runs: list[str]) -> None:
        """Encode the runs numbered last; one that starts with a blank is a word for the whole tokenizer."""
        plain = [run for run in runs if run[0] != " "]
        rows = [" ".join(plain[i : i + 500]) for i in range(0, len(plain), 500)]
        encoded = [e.ids for e in self.fast.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.array(list(chain.from_iterable(encoded)), np.uint32)
        bounds = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(bounds) != len(plain) + 1:
            raise ValueError("the vocabulary does not mark the end of every run")
        if len(plain) == len(runs):
            self.runs.extend(np.diff(bounds), ids)
            return
        parts = iter(np.split(ids, bounds[1:-1]))
        lists = [
            np.array(self.whole.encode(run[1:], add_special_tokens=False).ids, np.uint32) if run[0] == " " else next(parts)
            for run in runs
        ]
        self.runs.extend(np.fromiter(map(len, lists), np.int64, len(lists)), np.concatenate(lists))

    def _add(self, words: list[bytes]) -> None:
        """Encode the words numbered last."""
        known, find, flat, counts = len(self.run_index), self.run_index.__getitem__, [], []
        for raw in words:
            word = raw.decode("utf-8", "replace")
            if _SIMPLE.fullmatch(word) and "<|" not in word:
                parts = _RUNS.findall(word.lower())
                flat += map(find, parts)
                counts.append(len(parts))
            else:
                flat.append(find(" " + word))
                counts.append(1)
        if len(self.run_index) > known:
            self._encode_runs(list(islice(self.run_index, known, None)))
        ids, ends = self.runs.joined(np.array(flat, np.int64))
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
        self.words.extend(np.diff(bounds), ids)

    def texts(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.index) > self.limit:
            self.clear()
        known = len(self.index)
        # the tokenizer lowers letters itself, but its special tokens are told by their case
        split = [(text if b"<|" in text else text.lower()).split() for text in texts]
        n_words = np.fromiter(map(len, split), np.int64, len(split))
        find = self.index.__getitem__
        at = np.fromiter(map(find, chain.from_iterable(split)), np.int64, int(n_words.sum()))
        if len(self.index) > known:
            self._add(list(islice(self.index, known, None)))
        ids, ends = self.words.joined(at)
        bounds = ends[np.concatenate([[0], np.cumsum(n_words)])]
        return [ids[low:high] for low, high in zip(bounds, bounds[1:], strict=False)]


_words: dict[str, WordIds] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer_path: str, window: int, end_id: int, batch_bytes: int = 1 << 21) -> DataFrame:
    """Whole windows from the start of every document, then its tail; one row per piece.

    A null text counts as empty and yields the end id alone. Rows that repeat stay apart.
    """

    def cut(batch: pa.RecordBatch):
        words = _words.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
        _words[tokenizer_path] = words
        keys, texts = batch.column(0), batch.column(1)
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        bounds = [0, *(np.flatnonzero(np.diff(sizes // batch_bytes)) + 1), len(texts)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            rows = []
            part = [_composed(t) for t in texts.slice(low, high - low).to_pylist()]
            for key, ids in zip(keys.slice(low, high - low).to_pylist(), words.texts(part), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                data = memoryview(ids.tobytes())
                for start in range(0, len(ids), window):
                    length = min(window, len(ids) - start)
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    rows.append((key, start, length, crc, len(ids)))
            columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_column().alias("text"))
    return map_batches(source, cut, PIECES)


def _composed(text: str) -> bytes:
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.encode("utf-8", "replace")


@dataclass
class Plan:
    """Per slot: its tail length, the number of its first tail, how many tails a sequence takes,
    the first sequence and the offset there. ``sequences`` counts all."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """A multiset of lengths within ``counts`` whose sum is the largest that fits in ``room``.

    Bit s of the table is set when some multiset sums to s; one table per distinct length is kept,
    and walking back through them gives how often each length is taken. Longer lengths come first.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        steps.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left > 0:
            take = min(step, left)
            reach |= (reach << (length * take)) & mask
            left, step = left - take, step * 2
        if reach >> room & 1:
            break
    target, taken = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> target & 1:
            target, n = target - length, n + 1
        if n:
            taken[length] = n
    return taken


def plan(counts: dict[int, int], window: int) -> Plan:
    """Patterns for all tails. The longest tail left always opens a sequence."""
    counts = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(counts, 0)
    slots, sequences = [], 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        rest = {n: c for n, c in counts.items() if c}
        pattern = best_fill(rest, window - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        offset = 0
        for n in sorted(pattern, reverse=True):
            slots.append((n, used[n], pattern[n], sequences, offset))
            offset += n * pattern[n]
            used[n] += times * pattern[n]
            counts[n] -= times * pattern[n]
            if not counts[n]:
                del counts[n]
        sequences += times
    slots.sort()
    return Plan(*np.array(slots, np.int64).reshape(-1, 5).T, sequences)


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Sequences hold at
    most ``window`` ids and are gapless from 0. Null texts are empty, so such a document is its end
    id; null and repeated ``doc_id`` are kept row by row; an empty table gives no rows; further
    columns of ``docs`` are ignored. Pieces are written once, so each text is encoded once.
    """
    stored = written(pieces(docs, tokenizer_path, window, end_id), "pieces")
    counts = {
        r["length"]: r["count"] for r in stored.where(F.col("length") < window).groupBy("length").count().collect()
    }
    bins = plan(counts, window)
    rows = stored.select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    names = [f.split()[0] for f in PIECES.split(", ")]
    tails = running_totals(
        rows.where(F.col("length") < window), ["length"], ["_file"], ["_row"], {"number": F.lit(1)}
    ).select(*names, "number")
    # numbers stay below 2^40: with the length in front they make one sorted key
    keys = (bins.length << 40) + bins.first

    def place(batch: pa.RecordBatch):
        length = batch.column("length").to_numpy()
        number = batch.column("number").to_numpy()
        slot = np.searchsorted(keys, (length << 40) + number, "right") - 1
        nth = number - bins.first[slot]
        sequence = bins.sequence[slot] + nth // bins.each[slot]
        offset = bins.offset[slot] + nth % bins.each[slot] * length
        columns = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
        yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    whole = rows.where(F.col("length") == window).select(
        *names,
        (F.monotonically_increasing_id() + F.lit(bins.sequences)).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return map_batches(tails, place, PACKED).unionByName(whole)
