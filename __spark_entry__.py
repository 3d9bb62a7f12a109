
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from oracle_queries import N_SHARDS  # noqa: E402
from textvec.functions import bpe, text, vectors  # noqa: E402
from textvec.operators import embedding, layout, nearest, sharding  # noqa: E402
from textvec.operators.totals import running_totals  # noqa: E402
from textvec.params import BpeVocab, NearestParams, RunParams, TrainParams  # noqa: E402
from textvec.plans import pipeline, stages  # noqa: E402
from textvec.sinks import models  # noqa: E402
from textvec.sinks import text as sinks  # noqa: E402
from textvec.sources import tables  # noqa: E402
from textvec.sources import text as sources  # noqa: E402
from textvec.workspace import new_path, spread, written  # noqa: E402

try:
    import textvec.llm.entry as llm_entry  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("textvec.llm", "textvec.llm.entry", "corpus_pipeline"):
        raise
    llm_entry = None

VOCAB = BpeVocab()
# Few iterations and short vectors: the queries check vocabularies, not the quality of vectors.
SMALL = {"window": 5, "iterations": 1, "epochs": 1, "min_freq": 2, "partitions": 4}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, doc, text, size``."""
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select(
        "doc_id",
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("doc"),
        "text",
        F.octet_length("text").cast("bigint").alias("size"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc, line_no, line`` with the numeric document id."""
    return sources.table_lines(_documents(spark, sf_dir), doc="doc_id")


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shard, doc, line_no, ids`` with the white-space tokens of every line as ids."""
    lines = stages.document_lines(_documents(spark, sf_dir), 2)
    ids = text.white_space_tokens(F.col("line")).alias("ids")
    return lines.select("shard", "doc", "line_no", ids)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, label, word, freq, vector``."""
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id",
        "label",
        F.col("vec_id").cast("string").alias("word"),
        (F.col("label") + 1).cast("bigint").alias("freq"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def _flat(df: DataFrame, *columns) -> DataFrame:
    rows = df.select(*columns, F.posexplode("vector").alias("i", "value"))
    return rows.withColumn("i", F.col("i").cast("bigint")).withColumn("value", F.round("value", 6))


# -- sources ---------------------------------------------------------------------------------------


def src_lines(spark, sf_dir):
    return sources.table_lines(_documents(spark, sf_dir), doc="doc_id", offsets=True)


def src_list(spark, sf_dir):
    path = new_path(spark, "texts")
    _documents(spark, sf_dir).repartition(8, "doc_id").select("text").write.text(path)
    files = sources.list_text_files(spark, path)
    return files.agg(F.count("doc").alias("n_files"), F.sum("size").alias("bytes"))


def src_utf8(spark, sf_dir):
    stray, cut = (F.lit(b).cast("string") for b in (b"\xff", b"\xe2\x82"))
    damaged = F.concat(stray, F.replace("text", F.lit("\n"), F.concat(cut, F.lit("\n"))), cut)
    damaged = damaged.cast("binary")
    documents = _documents(spark, sf_dir)
    return documents.select("doc_id", text.drop_malformed(damaged).alias("text"))


def _written_tokens(spark, sf_dir):
    path = new_path(spark, "token_lines")
    sinks.write_tokens(_tokens(spark, sf_dir).where(F.size("ids") > 0), path)
    return path


def src_tokens(spark, sf_dir):
    tokens = tables.read_tokens(spark, _written_tokens(spark, sf_dir))
    return tokens.select(
        "shard", F.size("ids").cast("bigint").alias("n_tokens"), F.array_join("ids", " ").alias("line")
    )


def src_emb(spark, sf_dir):
    word = (
        F.when(F.col("label") == 0, ",")
        .when(F.col("label") == 1, "")
        .when(F.col("label") == 2, F.concat(F.lit("),w"), "word"))
        .when(F.col("label") == 3, "1,000")
        .when(F.col("label") == 4, "a,1")
        .when(F.col("label") == 5, F.concat(F.lit("12,"), "word"))
        .otherwise(F.concat(F.lit("w"), "word"))
    )
    source = _vectors(spark, sf_dir).select(
        word.alias("word"), (F.col("vec_id") + 1).alias("freq"), "vector"
    )
    path = new_path(spark, "embedding_lines")
    sinks.write_embeddings(source, path)
    return _flat(tables.read_embeddings(spark, path), "word", "freq")


def src_shards(spark, sf_dir):
    return embedding.shard_numbers(_tokens(spark, sf_dir))


# -- sinks -----------------------------------------------------------------------------------------


def snk_shards(spark, sf_dir):
    path = new_path(spark, "shards")
    documents = stages.shard_documents(_documents(spark, sf_dir), N_SHARDS, "doc_id")
    sinks.write_document_shards(documents, path, "doc_id")
    lines = sources.read_lines(spark, path, group=("shard",), across_files=True)
    return lines.select(F.col("shard").cast("bigint").alias("shard"), "line_no", "line")


def snk_tokens(spark, sf_dir):
    path = _written_tokens(spark, sf_dir)
    lines = sources.read_lines(spark, path, group=("shard",), across_files=True)
    return lines.select("shard", "line_no", "line")


def snk_emb(spark, sf_dir):
    path = new_path(spark, "embedding_lines")
    sinks.write_embeddings(_vectors(spark, sf_dir), path)
    return _flat(tables.read_embeddings(spark, path), "pos", "word", "freq")


def snk_closest(spark, sf_dir):
    path = new_path(spark, "closest_lines")
    # stored first: writing in order samples its input, which would score it twice
    sinks.write_closest(written(jon_closest(spark, sf_dir), "closest"), path)
    return sources.read_lines(spark, path, across_files=True).select("line_no", "line")


def snk_model(spark, sf_dir):
    path = new_path(spark, "model")
    tokens = written(_tokens(spark, sf_dir).select("ids"), "tokens")
    models.save_model(embedding.train(tokens, TrainParams(vector_size=8, **SMALL)), path)
    found = models.load_model(path).getVectors()
    return found.select(
        F.col("word").alias("token"), F.size(embedding.vector_to_array("vector")).cast("bigint").alias("dim")
    )


def snk_guard(spark, sf_dir):
    path = new_path(spark, "guarded")
    documents = _documents(spark, sf_dir)
    sinks.write_shards(documents.selectExpr("0 AS shard", "doc", "0 AS line_no", "doc_id AS line")
                       .withColumn("line", F.col("line").cast("string")), path)
    refused = False
    try:
        sinks.write_shards(documents.selectExpr("0 AS shard", "doc", "0 AS line_no", "doc AS line"), path)
    except AnalysisException:
        refused = sinks.path_exists(spark, path)
    return sources.read_lines(spark, path).agg(
        F.count("line").alias("n_rows"),
        F.sum(F.col("line").cast("bigint")).alias("keys"),
        F.lit(refused).alias("refused"),
    )


# -- projections and filters -----------------------------------------------------------------------


def prj_encode(spark, sf_dir):
    encoded = bpe.encode_lines(_lines(spark, sf_dir), VOCAB)
    return encoded.select("doc", "line_no", bpe.decoder_udf(spark, VOCAB)("ids").alias("text"))


def prj_decode(spark, sf_dir):
    """The visible ASCII of every line, put together from the words of its ids."""
    encoded = bpe.encode_lines(_lines(spark, sf_dir), VOCAB)
    words = bpe.words_udf(spark, VOCAB)("ids")
    visible = F.regexp_replace(F.array_join(words, ""), r"[^\x21-\x7e]", "")
    return encoded.select("doc", "line_no", visible.alias("visible"))


def flt_empty(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", F.translate("html", "<>", "\n\n").alias("text")
    )
    lines = sources.table_lines(spread(pages, "page_id"), doc="page_id")
    tokens = lines.select("doc", "line_no", text.white_space_tokens(F.col("line")).alias("ids"))
    return bpe.without_empty(tokens).select("doc", "line_no")


def prj_ids2str(spark, sf_dir):
    lengths = F.transform("ids", lambda token: F.length(token))
    lines = _tokens(spark, sf_dir).where(F.size("ids") > 0)
    texts = lines.select("doc", "line_no", text.ids_to_text(lengths).alias("ids_text"))
    ids = text.text_to_ids(F.col("ids_text"))
    total = F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return texts.select("doc", "line_no", "ids_text", total.alias("total"))


def prj_bundle(spark, sf_dir):
    bundles = _vectors(spark, sf_dir).select("word", F.struct("freq", "vector").alias("bundle"))
    total = F.aggregate("bundle.vector", F.lit(0.0), lambda a, x: a + x)
    return bundles.select(
        "word",
        "bundle.freq",
        F.size("bundle.vector").cast("bigint").alias("dim"),
        F.round(total, 6).alias("total"),
    )


def flt_self(spark, sf_dir):
    """Every label is a word with many vectors: none of them may be its own neighbour."""
    labelled = _vectors(spark, sf_dir).withColumn("word", F.col("label").cast("string"))
    return nearest.closest_words(labelled)


def flt_pos(spark, sf_dir):
    """Vectors on the axis of their label: other labels are orthogonal, and label 0 has no axis."""
    source = _vectors(spark, sf_dir)
    axis = F.transform("vector", lambda x, i: F.when(i + 1 == F.col("label"), x).otherwise(0.0))
    return nearest.closest_words(source.withColumn("vector", axis))


# -- joins -----------------------------------------------------------------------------------------


def jon_closest(spark, sf_dir):
    return nearest.closest_words(_vectors(spark, sf_dir))


def jon_closest_blocks(spark, sf_dir):
    """The plan for tables beyond the broadcast limit, on the same rows."""
    params = NearestParams(broadcast_bytes=0, block_rows=256)
    return nearest.closest_words(_vectors(spark, sf_dir), params=params)


def jon_lookup(spark, sf_dir):
    """The plan for few queries against a table beyond the broadcast limit: the table stays in place."""
    source = _vectors(spark, sf_dir)
    queries = source.select(F.concat(F.lit("q"), "word").alias("word"), F.reverse("vector").alias("vector"))
    params = NearestParams(broadcast_bytes=0, lookup_bytes=64 << 20)
    return nearest.lookup_closest(queries, source, params=params)


# -- aggregations ----------------------------------------------------------------------------------


def agg_vocab(spark, sf_dir):
    return embedding.count_vocab(_tokens(spark, sf_dir), 2)


def agg_mean(spark, sf_dir):
    labelled = _vectors(spark, sf_dir).withColumn("word", F.col("label").cast("string"))
    return _flat(embedding.merge_words(labelled), "word")


def agg_freq(spark, sf_dir):
    labelled = _vectors(spark, sf_dir).select(
        F.col("label").cast("string").alias("word"), (F.col("vec_id") + 1).alias("freq"), "vector"
    )
    return embedding.merge_words(labelled).select("word", "freq")


def agg_argmax(spark, sf_dir):
    """Sign vectors make many equal scores."""
    signs = F.transform("vector", lambda x: F.signum(x))
    return nearest.closest_words(_vectors(spark, sf_dir).withColumn("vector", signs))


def agg_limit(spark, sf_dir):
    return sharding.shard_limit(_documents(spark, sf_dir), N_SHARDS)


def agg_shard(spark, sf_dir):
    sizes = _documents(spark, sf_dir).select("doc_id", "size")
    return sharding.assign_shards(sizes, N_SHARDS, "doc_id").select("doc_id", "shard")


# -- layout ----------------------------------------------------------------------------------------


def ord_part(spark, sf_dir):
    return layout.add_shard(_documents(spark, sf_dir).select("doc"), 7)


def ord_comp(spark, sf_dir):
    """Position of every line in its shard, read off the stored order."""
    path = new_path(spark, "ordered")
    layout.lines_in_order(_tokens(spark, sf_dir).drop("ids")).write.parquet(path)
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    placed = running_totals(rows, ["shard"], ["file"], ["row"], {"pos": F.lit(1)})
    return placed.select("shard", "doc", "line_no", "pos")


def ord_word(spark, sf_dir):
    path = new_path(spark, "ordered")
    layout.words_in_order(_vectors(spark, sf_dir).select("word")).write.text(path)
    return sources.read_lines(spark, path, across_files=True).select(
        F.col("line_no").alias("pos"), F.col("line").alias("word")
    )


def set_union(spark, sf_dir):
    source = _vectors(spark, sf_dir)
    first = source.select(F.lit(0).alias("shard"), "word", "vector")
    second = source.select("vector", F.col("label").cast("string").alias("word"), F.lit(1).alias("shard"))
    return _flat(embedding.union_shards([first, second]), "shard", "word")


# -- scalar functions ------------------------------------------------------------------------------


def _neighbours(spark, sf_dir):
    source = _vectors(spark, sf_dir)
    first = source.select("vec_id", F.col("vector").alias("a"))
    second = source.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vector").alias("b"))
    return first.join(second, "vec_id")


def fn_dot(spark, sf_dir):
    product = vectors.dot(F.col("a"), F.col("b"))
    return _neighbours(spark, sf_dir).select("vec_id", F.round(product, 6).alias("dot"))


def fn_cosine(spark, sf_dir):
    score = vectors.cosine(F.col("a"), F.col("b"))
    return _neighbours(spark, sf_dir).select("vec_id", F.round(score, 6).alias("cosine"))


def fn_misc(spark, sf_dir):
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    key = F.concat_ws("#", F.col("n_chars").cast("string"), "source", name)
    parsed = _table(spark, sf_dir, "documents").select(text.parse_composite_key(key).alias("k"))
    return parsed.select("k.*", F.endswith("k.doc", F.lit(".txt")).alias("is_text"))


# -- training and pipeline -------------------------------------------------------------------------


def ml_w2v(spark, sf_dir):
    tokens = written(_tokens(spark, sf_dir), "tokens")
    vectors_ = embedding.train_shards(tokens, TrainParams(vector_size=16, **SMALL))
    return vectors_.select("shard", "token", "freq", F.size("vector").cast("bigint").alias("dim"))


def ml_export(spark, sf_dir):
    tokens = written(_tokens(spark, sf_dir), "tokens")
    exported = embedding.train_shards(tokens, TrainParams(vector_size=8, mode="global", **SMALL))
    finite = F.forall("vector", lambda x: F.abs(x) < float("inf"))
    return exported.select(
        "shard", "token", "freq", F.size("vector").cast("bigint").alias("dim"), finite.alias("finite")
    )


def _run(spark, sf_dir, path, min_freq):
    lines = stages.document_lines(_documents(spark, sf_dir), 2)
    train = TrainParams(vector_size=16, **SMALL | {"min_freq": min_freq})
    return pipeline.run_lines(lines, path, RunParams(token_shards=2, train=train, vocab=VOCAB))


def pipe_run(spark, sf_dir):
    """The whole run; per token shard what it stored, and what holds for all its words."""
    path = new_path(spark, "run")
    closest = _run(spark, sf_dir, path, 1)
    tokens = spark.read.parquet(f"{path}/{pipeline.TABLE_DIR}/tokens")
    words = spark.read.parquet(f"{path}/{pipeline.TABLE_DIR}/embeddings")
    size = bpe.token_table(spark, VOCAB).select(F.col("id").alias("token"), F.octet_length("bytes").alias("size"))
    stored = tokens.select("shard", "doc", "line_no", F.explode("ids").alias("token")).join(size, "token")
    stored = stored.groupBy("shard").agg(
        F.count_distinct("doc", "line_no").alias("lines"), F.sum("size").cast("bigint").alias("bytes")
    )
    n_ids = tokens.agg(F.sum(F.size("ids")).alias("n")).first()["n"]
    of_words = words.agg(F.sum("freq").alias("freq"), F.count("word").alias("n")).first()
    found = closest.join(words.select(F.col("word").alias("closest_word"), F.col("vector").alias("b")), "closest_word")
    found = found.join(words.select("word", F.col("vector").alias("a")), "word")
    other, near = F.col("word") != F.col("closest_word"), vectors.cosine(F.col("a"), F.col("b")) > 0
    of_closest = found.agg(F.count("word").alias("n"), F.bool_and(other).alias("other"), F.bool_and(near).alias("near"))
    of_closest = of_closest.first()
    return stored.select(
        "*",
        F.lit(n_ids == of_words["freq"]).alias("all_counted"),
        F.lit(of_closest["n"] == of_words["n"]).alias("all_found"),
        F.lit(of_closest["other"]).alias("closest_is_other"),
        F.lit(of_closest["near"]).alias("closest_is_near"),
    )


def pipe_shard(spark, sf_dir):
    sharded = stages.shard_documents(_documents(spark, sf_dir), N_SHARDS, "doc_id")
    return sharded.groupBy("shard").agg(F.count("doc").alias("n_docs"), F.sum("size").alias("bytes"))


def pipe_stages(spark, sf_dir):
    """Each stage from the files of the one before, on white-space tokens."""
    tokens = written(tables.read_tokens(spark, _written_tokens(spark, sf_dir)), "tokens")
    path = new_path(spark, "embedding_lines")
    sinks.write_embeddings(stages.embed(tokens, TrainParams(vector_size=16, **SMALL), None), path)
    words = written(tables.read_embeddings(spark, path), "embeddings")
    closest = nearest.closest_words(words, "pos")
    other = F.col("closest_word") != F.col("word")
    return words.join(closest, "word").select("word", "freq", other.alias("closest_is_other"))


QUERIES = [
    src_lines, src_list, src_utf8, src_tokens, src_emb, src_shards,
    snk_shards, snk_tokens, snk_emb, snk_closest, snk_model, snk_guard,
    prj_encode, flt_empty, prj_decode, prj_ids2str, prj_bundle, flt_self, flt_pos,
    jon_closest, jon_closest_blocks, jon_lookup,
    agg_vocab, agg_mean, agg_freq, agg_argmax, agg_limit, agg_shard,
    ord_part, ord_comp, ord_word, set_union, fn_dot, fn_cosine, fn_misc,
    ml_w2v, ml_export, pipe_run, pipe_shard, pipe_stages,
]


def entry(spark: SparkSession) -> DataFrame:
    """The whole pipeline on the smallest tables: every word with its nearest other word."""
    return _run(spark, "/root/testdata/sf0.001", new_path(spark, "run"), SMALL["min_freq"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in QUERIES}
    return found | (llm_entry.QUERIES if llm_entry else {})


def oracle_sql() -> dict[str, str]:
    """The DuckDB SQL of every query that SQL can express."""
    return oracle_queries.oracle_sql() | (llm_entry.ORACLE_SQL if llm_entry else {})
