"""Approximate nearest neighbours by a permutation index.

About 1.25 * sqrt(n) pivots, 128 at least, are chosen from a bounded sample. A vector is represented by its DEPTH nearest pivots in
order, and posted in the inverted file of the nearest one, so each vector is moved once. A query goes to the files of
its own nearest pivots, GROWTH * pivots ** POWER of them; their entries are ranked by the footrule distance of the
orders (ranks beyond DEPTH count as DEPTH), the best SHARE is reranked by exact cosine on the original vectors, and the
best of all files are merged. Both numbers grow less than the table up to MOST_PIVOTS pivots, some 2.7 million rows; beyond,
a query meets the same share of it, 48 %, so that work grows with queries times rows.

Files are dealt into shards of about BLOCK entries: small files share one, a file with more is cut into several. Queries
are dealt into blocks of QUERY_BLOCK. A task holds one shard at a time and streams queries past it, so a pivot near a
third of all rows, or of all queries, makes more tasks, not larger ones.

Vectors without any structure defeat every index: orders of random vectors say little, so most files have to be read
for a recall of 0.9, and the default numbers are set for that case. With neighbours that are much nearer than the rest,
a smaller `probed` will do.

Edge cases: vectors that are null, zero, of another length than most, or that hold null or non-finite components take no
part, as queries or candidates. Finite ones of any size do: they are scaled by a power of two, which changes no bit of
a cosine, before products could overflow or vanish. Of rows that repeat an id the best counts: an id is a neighbour
once, and a query's own id never. Ties go to the smaller id. With fewer candidates than asked for, all of them return.
A table without a usable vector gives an empty result. Columns beyond the named ones are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, plain, table

#: The least and most pivots, and the rows of the sample that one is chosen from.
LEAST_PIVOTS, MOST_PIVOTS, SAMPLE = 128, 2048, 4
DEPTH = 96
#: Files that a query goes to: GROWTH * pivots ** POWER.
GROWTH, POWER = 2.2, 0.8
#: The cosine from which a pivot says no more than another one.
ALIKE = 0.6
#: Of the entries in a shard's probed files, the share that is reranked, the least number, and the share of the largest
#: footrule distance within which all are: orders don't tell near-equal vectors apart.
SHARE, LEAST, NEAR = 0.1, 256, 0.03
BLOCK, QUERY_BLOCK = 4096, 1 << 16
#: Tasks of the search. Each streams through its shards.
MOST_TASKS = 20_000
#: Bytes of ranks held at once.
WORK = 32 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the rows of vectors(vec_id, embedding) that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.coalesce(sound, F.lit(False)))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to between 0.5 and 1."""
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -power)


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def choose_pivots(rows: DataFrame, pivots: int | None = None, seed: int = 6) -> np.ndarray:
    """Up to `pivots` vectors of those with the least hashes, in random order; near-equals of a chosen one come last.

    About SAMPLE rows a pivot come to the driver: the share of all that the hash of the id lets through, equal ones once.
    """
    n = rows.count()
    pivots = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, math.ceil(1.25 * math.sqrt(n))))
    share = min(1.0, SAMPLE * pivots / max(n, 1))
    few = rows.where(F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").distinct().collect()
    if not few and n:  # so few rows that the share may let none through
        few = rows.select("v").limit(SAMPLE * pivots).collect()
    if not few:
        return np.zeros((0, 0))
    width = pd.Series([len(r["v"]) for r in few]).mode()[0]
    x = np.unique(_unit(np.array([r["v"] for r in few if len(r["v"]) == width])), axis=0)
    x = x[np.random.default_rng(seed).permutation(len(x))]
    chosen, spare = [], []
    for i in range(len(x)):
        if len(chosen) == pivots:
            break
        alike = len(chosen) and (x[chosen] @ x[i]).max() > ALIKE
        (spare if alike else chosen).append(i)
    return x[(chosen + spare)[:pivots]]


def permutations(rows: DataFrame, pivots: np.ndarray, depth: int = DEPTH) -> DataFrame:
    """(id, vector binary, near binary, pivot): the scaled vector, and its `depth` nearest pivots in order."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = scaled(np.array(batch.column("v").to_pylist(), dtype=np.float64))
            near = np.argsort(-(_unit(x) @ pivots.T), axis=1, kind="stable")[:, :depth].astype(np.int16)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in near], pa.binary()), pa.array(near[:, 0], pa.int32())], names=["id", "vector", "near", "pivot"])

    return rows.where(F.size("v") == pivots.shape[1]).mapInArrow(place, "id long, vector binary, near binary, pivot int")


def shards(sizes: dict[int, int], pivots: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Each file's first shard and number of shards: files with more than a block are cut, the others share shards."""
    first, count = np.zeros(pivots, dtype=np.int64), np.ones(pivots, dtype=np.int64)
    at, held = 0, 0
    for p in range(pivots):
        n = sizes.get(p, 0)
        if held and held + n > block:
            at, held = at + 1, 0
        first[p], held = at, held + n
        if n > block:
            count[p] = -(-n // block)
            at, held = at + int(count[p]), 0
    return first, count


class Shard:
    """The entries of a shard, by file; equal vectors of a file are one entry with its ids in order."""

    def __init__(self, entries: pd.DataFrame, pivots: int, k: int):
        entries = entries.drop_duplicates(["id", "vector"]).sort_values(["pivot", "id"], kind="stable")
        entry, distinct = pd.factorize(entries["vector"])  # in order of files
        self.ids = [part[: k + 1] for part in np.split(entries["id"].to_numpy()[np.argsort(entry, kind="stable")], np.cumsum(np.bincount(entry))[:-1])]
        at = np.unique(entry, return_index=True)[1]
        self.x = np.frombuffer(b"".join(distinct), dtype=np.float64).reshape(len(distinct), -1)
        self.lengths = np.sqrt((self.x * self.x).sum(axis=1))
        self.file = entries["pivot"].to_numpy()[at]
        self.near = np.frombuffer(b"".join(entries["near"].to_numpy()[at]), dtype=np.int16).reshape(len(distinct), -1)
        self.pivots = pivots
        self.step = max(1, WORK // (2 * pivots))
        self.ranks = [self._ranks(a) for a in range(0, len(self.x), self.step)] if len(self.x) <= self.step else None

    def _ranks(self, a: int) -> np.ndarray:
        """Twice the rank of every pivot (rows) in the entries from a on (columns); beyond the prefix, twice its length."""
        near = self.near[a : a + self.step]
        out = np.full((self.pivots, len(near)), 2 * near.shape[1], dtype=np.int16)
        out[near.T, np.arange(len(near))[None, :]] = 2 * np.arange(near.shape[1], dtype=np.int16)[:, None]
        return out

    def footrule(self, near: np.ndarray) -> np.ndarray:
        """Footrule distances from an order to those of all entries, but for a constant.

        A pivot that only the entry's prefix has adds depth - rank; all ranks of a prefix add up to the same, so the sum
        over the order's own pivots of |place - rank| + rank, which is max(place, 2 * rank - place), says it all.
        """
        place = np.arange(len(near), dtype=np.int16)[:, None]
        parts = self.ranks or (self._ranks(a) for a in range(0, len(self.x), self.step))
        return np.concatenate([np.maximum(r[near] - place, place).sum(axis=0, dtype=np.int32) for r in parts])

    def best(self, query: int, vector: bytes, near: np.ndarray, probed: int, k: int, share: float) -> list[tuple[float, int]]:
        """(-score, id) of the k best in the query's files."""
        open_ = np.zeros(self.pivots, dtype=bool)
        open_[near[:probed]] = True
        rows = np.flatnonzero(open_[self.file])
        if not len(rows):
            return []
        order = near[: self.near.shape[1]]
        far, depth = self.footrule(order)[rows], len(order)
        most = min(len(rows), max(LEAST, math.ceil(share * len(rows))) + 1)
        least, span = depth * (depth - 1) // 2, depth * (depth + 1)
        at = rows[far <= max(np.partition(far, most - 1)[most - 1], least + NEAR * span)]
        y = np.frombuffer(vector, dtype=np.float64)
        score = (self.x[at] * y).sum(axis=1) / (self.lengths[at] * np.sqrt((y * y).sum()))
        # Entries by score until k ids are there, and those as near as the last one for the ties.
        found, last = {}, 0.0
        for j in np.argsort(-score, kind="stable"):
            if len(found) >= k and score[j] < last:
                break
            last = float(score[j])
            for i in self.ids[at[j]]:
                if i != query:
                    found.setdefault(int(i), last)
        return sorted((-s, i) for i, s in found.items())[:k]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int | None = None, probed: int | None = None, share: float = SHARE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries(vec_id, embedding) the k nearest of vectors found."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors)
    chosen = choose_pivots(rows, pivots)
    if not len(chosen):
        return empty
    n_pivots = len(chosen)
    probed = min(n_pivots, probed or math.ceil(GROWTH * n_pivots**POWER))
    scratch = Scratch(spark, "ann_search")
    index = scratch.save(permutations(rows, chosen), "index")
    asked = scratch.save(permutations(usable(queries), chosen, max(DEPTH, probed)), "asked")
    # At most MOST_PIVOTS numbers come to the driver.
    first, count = shards({r["pivot"]: r["n"] for r in index.groupBy("pivot").agg(F.count("*").alias("n")).collect()}, n_pivots, block)
    query_blocks = max(1, -(-asked.count() // query_block))
    of = lambda xs: F.get(F.from_json(F.lit(json.dumps(xs.tolist())), "array<int>"), F.col("pivot"))
    columns = ["shard", "query_block", "side", "id", "vector", "near", "pivot"]
    entries = index.withColumns({"shard": (of(first) + F.pmod(F.xxhash64("id"), of(count))).cast("int"), "query_block": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))), "side": F.lit(0)})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [np.frombuffer(b, dtype=np.int16)[:probed] for b in batch.column("near").to_pylist()]
            to = [np.unique(np.concatenate([np.arange(first[p], first[p] + count[p]) for p in x])) for x in near]
            at = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in to]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("id", "vector", "near", "pivot")), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *to]), pa.int32())], names=["id", "vector", "near", "pivot", "shard"])

    sent = asked.mapInArrow(send, "id long, vector binary, near binary, pivot int, shard int")
    sent = sent.withColumns({"query_block": F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"), "side": F.lit(1)})
    tasks = min(MOST_TASKS, 2 * query_blocks * int((first + count).max()))
    dealt = entries.select(*columns).unionByName(sent.select(*columns)).repartition(tasks, "shard", "query_block").sortWithinPartitions("shard", "query_block", "side")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, shard = None, [], None
        for batch in batches:
            frame = batch.to_pandas()
            for key, part in frame.groupby(["shard", "query_block"], sort=True):
                if key != held:
                    held, parts, shard = key, [], None
                parts.append(part[part["side"] == 0])
                asking = part[part["side"] == 1]
                if not len(asking):
                    continue
                if shard is None:
                    entries = pd.concat(parts)
                    shard = Shard(entries, n_pivots, k) if len(entries) else False
                if not shard:
                    continue
                found = [(q, -s, i) for q, v, b in zip(asking["id"], asking["vector"], asking["near"], strict=True) for s, i in shard.best(q, v, np.frombuffer(b, dtype=np.int16), probed, k, share)]
                cols = list(zip(*found, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[1], pa.float64())], names=["query_id", "vec_id", "score"])

    hits = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    # Rows that share an id keep the best score.
    merged = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # No window: at most k rows a shard come together, and only the best k of a query are kept.
    best = merged.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("i", "b")).select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "b.vec_id", (-F.col("b.s")).alias("score"))


def op6_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = plain(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)
