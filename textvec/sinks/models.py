"""Trained models on disk, in the layout of Spark ML's ``Word2VecModel``, which can load them too."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

from ..operators.skipgram import SkipGramModel
from ..params import TrainParams
from .text import path_exists

_CLASS = "org.apache.spark.ml.feature.Word2VecModel"


def save_model(model: SkipGramModel, path: str) -> None:
    """Write a model; an existing path is refused."""
    spark = model.vectors.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"path {path} already exists")
    settings = {
        "inputCol": "sentence",
        "outputCol": "vector",
        "vectorSize": model.params.vector_size,
        "minCount": model.params.min_freq,
        "windowSize": model.params.window,
        "seed": model.params.seed,
        "maxIter": model.params.max_iter,
        "numPartitions": model.tasks,
        "maxSentenceLength": model.longest,
    }
    head = {
        "class": _CLASS,
        "timestamp": int(time.time() * 1000),
        "sparkVersion": spark.version,
        "uid": f"Word2Vec_{uuid.uuid4().hex[:12]}",
        "paramMap": settings,
        "defaultParamMap": {"stepSize": 0.025},
    }
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    model.vectors.write.parquet(f"{path}/data")


def load_model(path: str) -> SkipGramModel:
    """A saved model, also one that Spark ML wrote; its vectors stay where they are."""
    spark = SparkSession.active()
    head = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    if head["class"] != _CLASS:
        raise ValueError(f"{path} holds a {head['class']}")
    told = head["defaultParamMap"] | head["paramMap"]
    settings = {
        "vector_size": told.get("vectorSize"),
        "min_freq": told.get("minCount"),
        "window": told.get("windowSize"),
        "seed": told.get("seed"),
        "iterations": told.get("maxIter"),
        "partitions": told.get("numPartitions"),
    }
    params = TrainParams(epochs=1, **{name: value for name, value in settings.items() if value is not None})
    vectors = spark.read.schema("word string, vector array<float>").parquet(f"{path}/data")
    return SkipGramModel(vectors, params, params.partitions, told.get("maxSentenceLength", 1))
