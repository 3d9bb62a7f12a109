"""Command line: ``python -m textvec {run,shard,tokenize,embed,closest} SOURCE TARGET [...]``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .params import BpeVocab, RunParams, TrainParams
from .plans import pipeline


def main() -> None:
    parser = argparse.ArgumentParser(prog="textvec")
    stages = parser.add_subparsers(dest="stage", required=True)
    for name in ("run", "shard", "tokenize", "embed", "closest"):
        stage = stages.add_parser(name)
        stage.add_argument("source")
        stage.add_argument("target")
        if name == "shard":
            stage.add_argument("shards", type=int)
        if name in ("run", "tokenize"):
            stage.add_argument("token_shards", type=int, nargs="?", default=2)
        if name in ("run", "embed"):
            stage.add_argument("vector_size", type=int, nargs="?", default=100)
            stage.add_argument("min_freq", type=int, nargs="?", default=2)
            stage.add_argument("--mode", default="per_shard")
        if name in ("run", "tokenize", "embed"):
            stage.add_argument("--ranks")
            stage.add_argument("--pattern")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("textvec").getOrCreate()
    if args.stage == "shard":
        return pipeline.shard_directory(spark, args.source, args.target, args.shards)
    if args.stage == "closest":
        return pipeline.closest_directory(spark, args.source, args.target)
    given = {"ranks_path": args.ranks, "pattern": args.pattern}
    vocab = BpeVocab(**{k: v for k, v in given.items() if v})
    if args.stage == "tokenize":
        return pipeline.tokenize_directory(spark, args.source, args.target, args.token_shards, vocab)
    train = TrainParams(vector_size=args.vector_size, min_freq=args.min_freq, mode=args.mode)
    if args.stage == "embed":
        return pipeline.embed_directory(spark, args.source, args.target, train, vocab)
    params = RunParams(token_shards=args.token_shards, train=train, vocab=vocab)
    pipeline.run(spark, args.source, args.target, params)


if __name__ == "__main__":
    main()
