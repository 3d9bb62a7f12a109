"""Periodic runs against a plain search of every stretch, and on the odd cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from textvec.llm import periodic
from textvec.llm.queries import op12_recursive_splitting

EMPTY = hashlib.sha256(b"").hexdigest()


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    found = []
    for period in range(1, len(words) // 3 + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            stretch = words[start : i + period]
            if i > start and len(stretch) >= max(24, 3 * period):
                smallest = next(q for q in range(1, period + 1) if stretch[q:] == stretch[:-q])
                if smallest == period:
                    found.append((start, len(stretch), period))
            i = max(i, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_report(key, text, planted: bool) -> tuple:
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(b"" if key is None else str(key).encode())
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    listed = "".join("%d,%d,%d\n" % run for run in runs)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digests = (hashlib.sha256(x).hexdigest() for x in (listed.encode(), b" ".join(kept)))
    return (key, len(runs), *told, *digests)


def mixed_words(rng: random.Random) -> list[bytes]:
    """Stretches of few words, some of them periodic, next to each other."""
    some, words = rng.choice([1, 2, 3, 5, 20]), []
    for _ in range(rng.randint(1, 6)):
        unit = [b"w%d" % rng.randrange(some) for _ in range(rng.randint(1, 25))]
        words += (unit * 9)[: rng.randint(1, 9 * len(unit))] if rng.random() < 0.5 else unit * 2
    return words


@pytest.mark.parametrize("scanned", [2048, 0])
def test_runs_of_mixed_words(monkeypatch, scanned):
    """With all lags compared word by word, and with the aligned blocks from lag 3 on."""
    monkeypatch.setattr(periodic, "SCANNED_WORDS", scanned)
    monkeypatch.setattr(periodic, "SCANNED_LAGS", 2)
    rng = random.Random(3)
    texts = [mixed_words(rng) for _ in range(200)]
    expected = [plain_runs(words) for words in texts]
    assert sum(map(len, expected)) > 100
    assert [runs for _, runs in periodic._with_runs(texts)] == expected


def test_a_false_match_of_hashes_is_compared_again(monkeypatch):
    monkeypatch.setattr(periodic, "SCANNED_WORDS", 0)
    monkeypatch.setattr(periodic._Hashes, "_same", lambda self, a, lag, size: True)
    rng = random.Random(4)
    texts = [[b"a%d" % rng.randrange(9) for _ in range(40)] + [b"u%d" % (i % 20) for i in range(90)] + [b"z"] * 9]
    assert [runs for _, runs in periodic._with_runs(texts)] == [plain_runs(words) for words in texts]


def test_splitting_keeps_what_may_hold_a_run():
    words = [b"rare"] + [b"a", b"b"] * 12 + [b"once"] + [b"c", b"d", b"e"] * 7
    codes = [words.index(w) for w in words]
    import numpy as np

    begins, sizes = periodic.surviving_segments(np.array(codes), np.zeros(len(codes)))
    assert (begins.tolist(), sizes.tolist()) == ([1], [24])  # the last part has 21 words


def test_long_texts_are_taken_whole():
    rng = random.Random(5)
    unit = [b"w%d" % rng.randrange(50) for _ in range(700)]
    words = [b"a%d" % rng.randrange(5) for _ in range(30_000)] + unit * 4 + [b"x"] * 50_000
    ((_, runs),) = periodic._with_runs([words])
    assert (len(words) - 50_000, 50_000, 1) in runs
    assert any(period == 700 and size >= 2800 for _, size, period in runs)


@pytest.fixture(scope="module")
def odd(spark):
    schema = "doc_id bigint, text string, start string, length int, n_runs string, unit string"
    ring = " ".join("abc"[i % 3] for i in range(40))
    texts = [
        (1, ring), (1, ring), (None, None), (None, ring), (2, None), (3, ""), (4, " \n\t"), (5, "x " * 24), (6, "x " * 23),
        (7, ring + "\u00a0end"), (8, "y " * 30 + "z z z " * 20 + "y " * 30), (9, "  " * 30), (10, "one"),
    ]
    rng = random.Random(6)
    texts += [(k, b" \n".join(mixed_words(rng)).decode()) for k in range(20, 120)]
    return spark.createDataFrame([(k, t, "s", 1, "n", "u") for k, t in texts], schema).repartition(5)


@pytest.mark.parametrize("planted", [False, True])
def test_report(odd, planted):
    words_of = periodic.words_with_planted_tail if planted else periodic.plain_words
    found = [tuple(row) for row in periodic.report(odd, words_of).collect()]
    expected = [plain_report(row["doc_id"], row["text"], planted) for row in odd.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_found_runs_and_collapsed_texts(odd):
    runs = periodic.found_runs(odd).where("doc_id in (1, 5, 7)").collect()
    assert sorted(map(tuple, runs)) == [(1, 0, 40, 3, "a b c"), (1, 0, 40, 3, "a b c"), (5, 0, 24, 1, "x"), (7, 0, 39, 3, "a b c")]
    new = periodic.collapsed(odd)
    assert new.columns == odd.columns and new.count() == odd.count()
    texts = {row["doc_id"]: row["text"] for row in new.collect()}
    assert texts[5] == "x" and texts[1] == "a b c" and texts[6] == "x " * 23 and texts[2] is None and texts[4] == " \n\t"
    assert texts[7] == "a b c a\u00a0end"


def test_empty_table(odd):
    none = odd.where("false")
    assert periodic.report(none).collect() == periodic.found_runs(none).collect() == periodic.collapsed(none).collect() == []


def test_query_covers_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = [tuple(row) for row in op12_recursive_splitting(spark, sf_dir).collect()]
    short = [row for row in docs if len(row["text"].split()) < 2000]
    assert len(found) == len(docs) and len(short) > 150
    by_id = {row[0]: row for row in found}
    assert all(by_id[row["doc_id"]] == plain_report(row["doc_id"], row["text"], True) for row in short)
    assert sum(row[1] for row in found) > 5
