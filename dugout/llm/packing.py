"""Packing into optimal length buckets.

Documents become pieces of at most `context` tokens (full windows and what is left), given by their code points in the
text: a piece ends with its last token, the next begins there, and the last one ends with the text, so pieces add up to
the whole text. The histogram of all pieces'
lengths, at most context + 1 numbers, is aggregated by Spark; dynamic programming over it chooses the `buckets` upper
bounds with the least padding in total. Inside a bucket, pieces are numbered in a hashed order and every
budget // bound of them are a batch, padded to the bound. The numbers come from shards of bounded size and the shards'
offsets, so that a bucket with a third of all pieces is no single task's.

Edge cases: a document without tokens (null or empty text) is one piece of length 0 and takes a place in the first
bucket. Rows that repeat an id are packed each. A null id is an id like another. With fewer distinct lengths than
buckets each length is a bucket. An empty table gives an empty result. Columns beyond the named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, plain, slices, table

CONTEXT, BUCKETS, BUDGET = 2048, 16, 1 << 16
#: Pieces of a bucket that one task numbers, on average.
SHARD = 8192


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least sum of counts * (bound - length)."""
    order = np.argsort(lengths)
    x, n = np.asarray(lengths)[order].astype(np.float64), np.asarray(counts)[order].astype(np.float64)
    if not len(x):
        return []
    number, total = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * x)])
    # cost[j]: the least padding of the first j lengths in the buckets so far; from[b][j]: where the last one begins.
    cost = np.concatenate([[0], number[1:] * x - total[1:]])
    begins = [np.zeros(len(x) + 1, dtype=np.int64)]
    for _ in range(min(buckets, len(x)) - 1):
        after, begin = cost.copy(), np.zeros(len(x) + 1, dtype=np.int64)
        for j in range(1, len(x) + 1):
            tried = cost[:j] + (number[j] - number[:j]) * x[j - 1] - (total[j] - total[:j])
            begin[j] = np.argmin(tried)
            after[j] = tried[begin[j]]
        cost = after
        begins.append(begin)
    bounds, j = [], len(x)
    for begin in reversed(begins):
        if j == 0:
            break
        bounds.append(int(x[j - 1]))
        j = int(begin[j])
    return bounds[::-1]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def cut_texts(texts: list[bytes], context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, piece, n_tokens, start, end) of all pieces of UTF-8 texts, in order; start and end are code points."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    ends = np.flatnonzero(np.diff(_SPACE[raw].astype(np.int8), prepend=np.int8(1)) == 1)  # the sign after each token
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # code points before each byte
    first = np.searchsorted(ends, bounds)
    tokens = np.diff(first)
    count = np.maximum(1, -(-tokens // context))
    text = np.repeat(np.arange(len(texts)), count)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    last = piece == count[text] - 1
    cut = np.where(last, bounds[text + 1] - 1, ends[np.minimum(first[text] + (piece + 1) * context - 1, len(ends) - 1)] if len(ends) else 0)
    end = points[cut] - points[bounds[text]]
    start = np.where(piece == 0, 0, np.concatenate([[0], end[:-1]]))
    return text, piece, np.minimum(context, tokens[text] - piece * context), start, end


def pieces(docs: DataFrame, context: int = CONTEXT) -> DataFrame:
    """(doc_id, piece, n_tokens, start, end) of docs(doc_id, text): windows of `context` tokens and the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, texts in slices(batch):
                text, piece, n, start, end = cut_texts(texts, context)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(text + a)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (n, start, end))], names=["doc_id", "piece", "n_tokens", "start", "end"])

    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, n_tokens long, start long, end long")


def pack(docs: DataFrame, context: int = CONTEXT, buckets: int = BUCKETS, budget: int = BUDGET, shard: int = SHARD) -> DataFrame:
    """(doc_id, piece, n_tokens, start, end, bucket, batch, slot, padding) of docs(doc_id, text).

    bucket is the upper bound, batch a number inside the bucket, slot the place in the batch.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.save(pieces(docs, context), "pieces")
    histogram = cut.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    lengths, counts = np.array([r["n_tokens"] for r in histogram], dtype=np.int64), np.array([r["n"] for r in histogram], dtype=np.int64)
    bounds = optimal_bounds(lengths, counts, buckets)
    if not bounds:
        bounds = [0]
    held = np.bincount(np.searchsorted(bounds, lengths), weights=counts, minlength=len(bounds)) if len(lengths) else np.zeros(1)
    shards = [max(1, -(-int(n) // shard)) for n in held]
    room = [max(1, budget // max(1, b)) for b in bounds]
    number = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    pick = lambda values: F.get(F.array(*map(F.lit, values)), F.col("b"))
    placed = cut.withColumn("b", number).withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "doc_id", "piece"), pick(shards)))
    sizes = placed.groupBy("b", "shard").agg(F.count("*").alias("n"))
    before = sizes.select("b", "shard", (F.sum("n").over(W.partitionBy("b").orderBy("shard")) - F.col("n")).alias("before"))
    own = F.row_number().over(W.partitionBy("b", "shard").orderBy(F.xxhash64(F.lit(11), "doc_id", "piece"), "doc_id", "piece", "start", "end")) - 1
    numbered = placed.withColumn("i", own).join(before, ["b", "shard"]).withColumn("i", F.col("i") + F.col("before"))
    return numbered.select("doc_id", "piece", "n_tokens", "start", "end", pick(bounds).cast("long").alias("bucket"), F.floor(F.col("i") / pick(room)).alias("batch"), (F.col("i") % pick(room)).alias("slot"), (pick(bounds) - F.col("n_tokens")).cast("long").alias("padding"))


def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
