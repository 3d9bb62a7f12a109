"""The pipeline on a small corpus with planted cases, against plain versions of its stages."""

from __future__ import annotations

import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402
from test_operators import sentence  # noqa: E402

import corpus_pipeline  # noqa: E402
from textvec.llm import packing  # noqa: E402

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, _row string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean texts 0-199, marked ones 200-259, copies 300-309, near copies 310-319, leaks 320-329, odd rows."""
    rng = random.Random(11)

    def text():
        return "\n".join(sentence(rng, rng.randint(8, 25)) for _ in range(rng.randint(4, 8)))

    clean = [text() for _ in range(200)]
    rows = list(enumerate(clean))
    rows += [(200 + i, " ".join(w + "%%%" for w in text().split(" "))) for i in range(60)]
    rows += [(300 + i, clean[i]) for i in range(10)]
    for i in range(10):
        words = clean[20 + i].split(" ")
        words[len(words) // 2] = "altered"
        rows.append((310 + i, " ".join(words)))
    items = [sentence(rng, 30) for _ in range(10)]
    rows += [(320 + i, text() + "\n" + items[i] + "\n" + text()) for i in range(10)]
    rows += [(None, None), (None, clean[5]), (400, clean[0] + "\n" + sentence(rng, 40))]
    at = str(tmp_path_factory.mktemp("tables"))
    frame = spark.createDataFrame([(k, t, "de", "s", 1, "x", "y") for k, t in rows], DOCUMENTS)
    frame.write.parquet(f"{at}/documents.parquet")
    labels = [(k, 0 if 200 <= k < 260 else 1, 0) for k, _ in rows if k is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows


def test_stages_keep_what_they_should(spark, corpus):
    at, rows = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, found = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, at), "stage")
        found.append((name, {r["doc_id"] for r in docs.select("doc_id").collect()}))
        if name != "packing":
            assert docs.columns == columns
    kept = dict(found)
    everything = {k for k, _ in rows}
    assert kept["quality classifier"] == everything - set(range(200, 260))
    texts = plain.line_dedup([(1 << 40 if k is None else k, t) for k, t in rows if t and not (k and 200 <= k < 260)])
    gone = {k for k, t in texts.items() if not plain.WORD.search(t)}
    assert set(range(300, 310)) <= gone and kept["line dedup"] - {None} == set(texts) - gone - {1 << 40}
    assert set(range(200)) <= kept["simhash near-dedup"]
    assert kept["benchmark decontamination"] - {None} == kept["simhash near-dedup"] - {None} - set(range(320, 330))
    assert kept["packing"] == kept["benchmark decontamination"]


def test_run_packs_the_kept_texts(spark, corpus):
    at, rows = corpus
    result = corpus_pipeline.run(spark, at)
    assert result.columns == [f.split()[0] for f in packing.PACKED.split(", ")]
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in result.collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    texts = plain.line_dedup([(1 << 40 if k is None else k, t) for k, t in rows if t and not (k and 200 <= k < 260)])
    words = packing.WordIds(packing.default_tokenizer())
    for key in set(pieces) & set(range(200)):
        ids = np.append(words.texts([texts[key].encode()])[0], np.uint32(1)).astype("<u4")
        assert [(p["start"], p["length"], p["ids_crc32"]) for p in pieces[key]] == [(0, len(ids), zlib.crc32(ids.tobytes()))]
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_take_empty_tables(spark, corpus):
    at, _ = corpus
    docs = spark.read.parquet(f"{at}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, at), "stage")
        assert docs.count() == 0
