"""Language-model scores: prediction by partial matching over bytes, and a word unigram base.

The model is a trie of byte contexts of up to ``ORDER`` bytes with the counts of what follows them in
the training documents. A symbol is coded in the longest context; if the context was never followed
by it, an escape is coded and the next shorter context is tried without the symbols that the longer ones have
already ruled out. Escapes are estimated by method D: with ``t`` occurrences of ``d`` distinct symbols
left, a symbol seen ``c`` times has probability ``(2c - 1) / 2t`` and the escape ``d / 2t``. Below order zero all symbols still left are equally likely. A text is its bytes and
one end symbol, and starts after ``ORDER`` boundary symbols.

The symbols seen after a context are also seen after its shorter forms, so the set that is excluded
below a context is exactly the set seen there. The code length of a symbol therefore depends only on
the last ``ORDER`` bytes and the symbol itself, a *gram*; it is worked out once per distinct gram of the
corpus, in parallel over the last two bytes of the context, with the tables of order one and zero (at
most 257 x 257 numbers) as the only thing that all tasks get.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.llm.chunks import dealt, each_chunk, with_answers
from textvec.llm.common import crc32_remainder, text_column
from textvec.workspace import written

ORDER = 4
BITS, SYMBOLS = 9, 257  # a symbol is 0 for a boundary, else a byte and one
MASK = (1 << BITS) - 1
CHUNK_BYTES = 1 << 25
GRAM, WORD, END = 0, 1, 2

SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)
NAMES = [field.split()[0] for field in SCORES.split(", ")]


def grams(text: bytes) -> np.ndarray:
    """For every byte and the end: the ``ORDER`` symbols before it and itself, as one number."""
    symbols = np.zeros(len(text) + ORDER + 1, np.int64)
    symbols[ORDER:-1] = np.frombuffer(text, np.uint8)
    symbols[ORDER:-1] += 1
    n = len(text) + 1
    out = np.zeros(n, np.int64)
    for i in range(ORDER + 1):
        out <<= BITS
        out |= symbols[i : i + n]
    return out


def word_hashes(words) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64).view(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)


def _asked(chunk: int, batches) -> pa.Table:
    """The distinct grams and words of a chunk, with their counts in its training documents."""
    gram_keys, gram_counts, words, ends = [], [], {}, [0, 0]
    for batch in batches:
        held = batch.column("held_out").to_pylist()
        texts = [t.as_py() for t in batch.column("text").cast(pa.binary())]
        for out in (False, True):
            part = [t for t, h in zip(texts, held, strict=True) if h == out]
            ends[out] += len(part)
            for low in range(0, len(part), 2000):
                some = part[low : low + 2000]
                keys, counts = np.unique(np.concatenate([grams(t) for t in some]), return_counts=True)
                gram_keys.append(keys)
                gram_counts.append(np.zeros_like(counts) if out else counts)
            if out:
                for word in chain.from_iterable(t.lower().split() for t in part):
                    words.setdefault(word, 0)
            else:
                for word in chain.from_iterable(t.lower().split() for t in part):
                    words[word] = words.get(word, 0) + 1
    keys, counts = _merged(gram_keys, gram_counts)
    hashes = word_hashes(words)
    all_keys = np.concatenate([keys, hashes, [0]])
    all_counts = np.concatenate([counts, np.fromiter(words.values(), np.int64, len(words)), [ends[0]]])
    kinds = np.repeat(np.array([GRAM, WORD, END], np.int8), [len(keys), len(hashes), 1])
    return pa.table(
        [np.full(len(kinds), chunk), kinds, all_keys, all_counts], names=["chunk", "kind", "key", "n"]
    )


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which group of equal keys each row is in, and the first row of each group."""
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return at, first


def code_lengths(gram: np.ndarray, n: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last symbol.

    ``gram`` are all distinct grams of the corpus whose contexts end in the same two symbols, ``n`` how
    often the training documents have them; ``pairs[c, s]`` counts symbol ``s`` after symbol ``c`` there.
    """
    symbol = gram & MASK
    context = gram >> BITS
    logs = np.zeros(len(gram))
    open_ = np.ones(len(gram), bool)
    counts = []
    for order in range(ORDER, 1, -1):
        node = context & ((1 << BITS * order) - 1)
        pair, first = _groups((node << BITS) | symbol)
        if order == ORDER:
            count = n
        else:
            count = np.bincount(pair, n, len(first)).astype(np.int64)[pair]
        where, start = _groups(node)
        once = np.zeros(len(gram), bool)
        once[first] = True  # one row per pair of node and symbol
        total = np.bincount(where[once], count[once], len(start))[where]
        kinds = np.bincount(where[once], count[once] > 0, len(start))[where]
        counts.append((count, total, kinds, where, start, once))
    ones, zeros = pairs.astype(np.float64), pairs.sum(axis=0).astype(np.float64)
    last = context & MASK
    count1, total1, kinds1 = ones[last, symbol], ones.sum(axis=1)[last], (ones > 0).sum(axis=1)[last]
    levels = [(c, t, k) for c, t, k, *_ in counts]
    levels.append((count1, total1, kinds1))
    levels.append((zeros[symbol], np.full(len(gram), zeros.sum()), np.full(len(gram), (zeros > 0).sum())))
    gone_total, gone_kinds = np.zeros(len(gram)), np.zeros(len(gram))
    for i, (count, total, kinds) in enumerate(levels):
        total_left, kinds_left = total - gone_total, kinds - gone_kinds
        whole = 2 * total_left
        here = open_ & (count > 0)
        logs[here] += np.log10((2 * count[here] - 1) / whole[here])
        open_ &= ~here
        escape = open_ & (kinds_left > 0)
        logs[escape] += np.log10(kinds_left[escape] / whole[escape])
        if i + 1 < len(levels):
            lower = levels[i + 1][0]
            if i < len(counts):
                _, _, _, where, start, once = counts[i]
                seen = once & (count > 0)
                gone_total = np.bincount(where[seen], lower[seen], len(start))[where]
            else:
                gone_total = ((ones > 0) * zeros).sum(axis=1)[last]
            gone_kinds = kinds
    left = SYMBOLS - (zeros > 0).sum()
    logs[open_] -= np.log10(left)
    return logs


def score(docs: DataFrame, held_out, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Every text's scores by models learned from the documents where ``held_out`` is false.

    Columns as in ``SCORES``. ``score`` is the log10 probability of the text's bytes and its end by the
    byte model, ``base_score`` the sum of the smoothed unigram terms of its lower-cased words and one end,
    ``n_known`` how many of them training has. A null text is empty: one end token. A document
    without ``doc_id`` counts as one whose id is the empty string; rows that repeat count and are
    scored row by row; an empty table gives no rows; further columns are ignored.
    """
    source = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), text_column().alias("text")
    )
    parts = dealt(source, "doc_id", "text", chunk_bytes)
    asked = written(each_chunk(parts, _asked, "chunk bigint, kind tinyint, key bigint, n bigint"), "asked")
    totals = asked.where(F.col("kind") == GRAM).groupBy("key").agg(F.sum("n").alias("n"))
    totals = written(totals, "grams")
    pair = F.col("key").bitwiseAND((1 << 2 * BITS) - 1).alias("pair")
    pairs = np.zeros((SYMBOLS, SYMBOLS), np.int64)
    for row in totals.where("n > 0").groupBy(pair).agg(F.sum("n").alias("n")).collect():
        pairs[row["pair"] >> BITS, row["pair"] & MASK] = row["n"]

    def worked_out(table: pa.Table) -> pa.Table:
        gram = table.column("key").to_numpy()
        return pa.table([gram, code_lengths(gram, table.column("n").to_numpy(), pairs)], names=["key", "value"])

    tail = F.shiftright("key", BITS).bitwiseAND((1 << 2 * BITS) - 1)
    lengths = (
        totals.withColumn("tail", tail).groupBy("tail").applyInArrow(worked_out, "key bigint, value double")
    )
    gram_answers = asked.where(F.col("kind") == GRAM).select("chunk", "kind", "key").join(lengths, "key")
    word_rows = asked.where(F.col("kind") == WORD)
    word_totals = word_rows.groupBy("key").agg(F.sum("n").alias("n")).where("n > 0")
    tokens = word_totals.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = asked.where(F.col("kind") == END).agg(F.sum("n").alias("n")).first()["n"] or 0
    n_all = (tokens["n"] or 0) + ends
    scale = float(n_all + tokens["v"] + (ends > 0) + 1)
    word_answers = word_rows.select("chunk", "kind", "key").join(word_totals, "key").select(
        "chunk", "kind", "key", F.col("n").cast("double").alias("value")
    )
    answers = gram_answers.select("chunk", "kind", "key", "value").unionByName(word_answers)

    def scored(batches, found: pa.Table) -> pa.Table:
        kind, key, value = (found.column(c).to_numpy() for c in ("kind", "key", "value"))
        tables = []
        for k in (GRAM, WORD):
            mine = kind == k
            order = np.argsort(key[mine])
            tables.append((key[mine][order], value[mine][order]))
        (gram_keys, logs), (word_keys, counts) = tables
        out = []
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text").cast(pa.binary())]
            split = [t.lower().split() for t in texts]
            number = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(split)))}
            hashes = word_hashes(number)
            at = np.minimum(np.searchsorted(word_keys, hashes), max(0, len(word_keys) - 1))
            known = word_keys[at] == hashes if len(word_keys) else np.zeros(len(hashes), bool)
            seen = np.where(known, counts[at], 0.0) if len(word_keys) else np.zeros(len(hashes))
            terms = np.log10((seen + 1) / scale)
            end_term = np.log10((ends + 1) / scale)
            for doc, held, text, words in zip(
                batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts, split, strict=True
            ):
                place = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                total = logs[np.searchsorted(gram_keys, np.sort(grams(text)))].sum()
                out.append(
                    (
                        doc, held, len(words) + 1, int(known[place].sum()) + (ends > 0), n_all,
                        float(terms[place].sum() + end_term), float(total),
                    )
                )
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        columns = list(zip(*out, strict=True)) or [()] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)

    return with_answers(parts, answers, scored, SCORES)


def held_out(divisor: int = 7, remainder: int = 2):
    return crc32_remainder("doc_id", divisor) == remainder
