"""Hashed TF-IDF terms of texts and their latent space by randomised SVD.

Words are hashed into a fixed number of terms, so every table over terms has a bounded size whatever
the corpus holds: document frequencies and the projection are arrays that all tasks may get.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textvec.workspace import ship_package


class Numbered(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def numbered(token_lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The number of every token, how many tokens each list has, and the tokens by number."""
    index = Numbered()
    counts = np.fromiter(map(len, token_lists), np.int64, len(token_lists))
    at = np.fromiter(map(index.__getitem__, chain.from_iterable(token_lists)), np.int64, int(counts.sum()))
    return at, counts, list(index)


def hashed(tokens, n_terms: int, seed: int = 0) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(seed)), np.uint64)
    return (hashes % np.uint64(n_terms)).astype(np.int64)


PICKS = 1 << 15


def summed(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; an empty run sums to zero."""
    out = np.zeros((len(counts), rows.shape[1]), rows.dtype)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[full]
        out[full] = np.add.reduceat(rows, starts, axis=0)
    return out


def summed_picks(rows: np.ndarray, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``summed(rows[at], counts)``; about ``PICKS`` picked rows, or one run, stand in memory at a time."""
    ends = np.cumsum(counts)
    cuts = [0, *(np.flatnonzero(np.diff(ends // PICKS)) + 1), len(counts)]
    out = np.zeros((len(counts), rows.shape[1]), rows.dtype)
    for low, high in zip(cuts, cuts[1:], strict=False):
        if low < high:
            out[low:high] = summed(rows[at[ends[low] - counts[low] : ends[high - 1]]], counts[low:high])
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; a zero row stays zero."""
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def document_frequencies(
    df: DataFrame, terms: Callable[[pa.RecordBatch], Iterator[tuple]], n_terms: int
) -> tuple[np.ndarray, int]:
    """In how many of all documents each term is, and how many there are.

    ``terms`` yields, for one part of a batch after the other, the term numbers and how many each document
    has. Every task counts part by part and sends one row per term, summed by Spark; at most ``n_terms``
    sums reach the driver.
    """
    ship_package(df.sparkSession)

    def count(batches):
        sums, total = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            for flat, counts in terms(batch):
                doc = np.repeat(np.arange(len(counts)), counts)
                pairs = np.sort(doc * n_terms + flat)  # far faster than np.unique, which hashes
                found = pairs[np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)]] % n_terms
                sums += np.bincount(found, minlength=n_terms)
                total += len(counts)
        used = np.flatnonzero(sums)
        keys = np.append(used, -1)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.append(sums[used], total))], ["term", "n"])

    rows = df.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(n_terms, np.int64), 0
    for row in rows:
        if row["term"] < 0:
            total = row["n"]
        else:
            out[row["term"]] = row["n"]
    return out, total


def inverse_frequencies(frequencies: np.ndarray, total: int) -> np.ndarray:
    return np.log((total + 1) / (frequencies + 1)).astype(np.float32)


def projection(rows: DataFrame, n_terms: int, rank: int, rounds: int = 3, seed: int = 7) -> np.ndarray:
    """``n_terms x rank``: the leading right singular directions of sparse rows ``terms, weights``.

    Randomised SVD: a random block is carried through ``rounds`` power steps of X^T X with a QR
    factorisation after each, and the small Gram matrix of the last block gives the directions. A
    step is one job: tasks send their share of X^T X B in slices of terms, Spark brings the parts of a
    slice together, and the driver gets the sums, whose size is that of the block.
    """
    rng = np.random.default_rng(seed)
    # single precision throughout: the driver holds a few such blocks
    block = np.linalg.qr(rng.standard_normal((n_terms, rank + 8), dtype=np.float32))[0]
    for _ in range(rounds):
        block = np.linalg.qr(_power(rows, block))[0]
    small = block.T @ _power(rows, block)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:rank]
    return (block @ vectors[:, order]).astype(np.float32)


NONZEROS = 65_536  # of the sparse rows worked on at a time
SLICE_TERMS = 4096
TASK_ROWS = 1 << 17


def in_tasks(rows: DataFrame) -> DataFrame:
    """The rows of a stored table in eight tasks, or one for each ``TASK_ROWS`` where those are more: a
    task of ``projection`` sends as much as a block has, however few its rows are."""
    return rows.coalesce(max(8, -(-rows.count() // TASK_ROWS)))


def _power(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    n_terms, width = block.shape

    def share(batches):
        total = np.zeros((n_terms, width), np.float32)
        for batch in batches:
            terms, weights = batch.column("terms"), batch.column("weights")
            counts = np.diff(terms.offsets.to_numpy())
            flat, weight = terms.flatten().to_numpy(), weights.flatten().to_numpy()[:, None]
            ends = np.cumsum(counts)
            cuts = [0, *(np.flatnonzero(np.diff(ends // NONZEROS)) + 1), len(counts)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low < high:
                    part = slice(ends[low] - counts[low], ends[high - 1])
                    _add_share(total, block, counts[low:high], flat[part], weight[part])
        task = TaskContext.get().partitionId()
        for first in range(0, n_terms, SLICE_TERMS):
            part = total[first : first + SLICE_TERMS]
            if part.any():
                columns = [pa.array([first // SLICE_TERMS]), pa.array([task], pa.int32()), pa.array([part.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "task", "part"])

    def added(key: tuple, parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")  # in a fixed order, so that the sum does not depend on their arrival
        total = sum(np.frombuffer(part.as_buffer(), np.float32).astype(np.float64) for part in parts["part"])
        return pa.table({"slice": [key[0].as_py()], "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    parts = rows.mapInArrow(share, "slice bigint, task int, part binary").groupBy("slice")
    total = np.zeros((n_terms, width), np.float32)
    for row in parts.applyInArrow(added, "slice bigint, part binary").collect():  # as large as the block
        part = np.frombuffer(row["part"], np.float32).reshape(-1, width)
        total[row["slice"] * SLICE_TERMS :][: len(part)] = part
    return total


def _add_share(total: np.ndarray, block: np.ndarray, counts: np.ndarray, flat: np.ndarray, weight: np.ndarray) -> None:
    inner = summed(block[flat] * weight, counts)
    outer = np.repeat(inner, counts, axis=0) * weight
    order = np.argsort(flat, kind="stable")
    used, first = np.unique(flat[order], return_index=True)
    if len(used):
        total[used] += np.add.reduceat(outer[order], first, axis=0)
