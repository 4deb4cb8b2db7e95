"""Line dedup over levelled sorted runs of line hashes.

A run is a table of (h1, h2, n_docs, last_doc), one row per line key, bucketed by the 128-bit hash of the key and sorted
inside each bucket. Batches of documents come newest first (descending ids). Each new batch is merge-anti-joined with
the runs: keys that no run has are new, and their largest id in the batch is the document that keeps the line; keys that
a run has only add to the document count. The batch then becomes a run of level 0. Whenever a level holds `fanout` runs,
they are merged into one run of the next level, so that a key is looked up in few runs and each row is rewritten once a
level. All runs have the same buckets, one sorted file each, so neither the anti-join nor the merging moves a
row of theirs through the cluster: only the new batch, aggregated, is dealt out.

The key of a line is the line without white space at either end and with A-Z lower-cased. Keys of at least `min_points`
code points that `min_docs` documents hold lose their lines, except in the largest id that holds them.

Edge cases: a null or empty text is one empty line. Rows that repeat an id count as one document, and each of them
returns. A document without an id keeps all of its lines and isn't counted. An empty table gives an empty result.
Columns beyond the named ones are carried through untouched by dedup_lines() and not read by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import BLANKS, Scratch, plain, table

MIN_POINTS = 40
MIN_DOCS = 5
#: Batches that a whole table is taken in, and the runs a level may hold.
BATCHES = 4
FANOUT = 2
#: Buckets of the runs: the least and most, and the line keys of a table for which there is one.
LEAST_BUCKETS, MOST_BUCKETS, BUCKET_KEYS = 8, 1 << 16, 1 << 20


def line_key(line: bytes, min_points: int = MIN_POINTS) -> bytes | None:
    """The key of a line; None if it is too short to count."""
    key = line.strip(BLANKS)
    if len(key) < min_points:
        return None
    if len(key) < 4 * min_points and len(key.decode("utf-8", "replace")) < min_points:
        return None
    return key.lower()  # of bytes: A-Z only


def _hash(key: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def line_hashes(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """(doc_id, h1, h2): the distinct line keys of each row of docs(doc_id, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, h1, h2 = [], [], []
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                found = {_hash(k) for k in (line_key(x, min_points) for x in (text.as_py() or b"").split(b"\n")) if k is not None}
                ids += [i] * len(found)
                h1 += [a for a, _ in found]
                h2 += [b for _, b in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc_id").type), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["doc_id", "h1", "h2"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(read, f"doc_id {kind}, h1 long, h2 long")


class LineRuns:
    """The levels of runs. append() takes batches in descending order of ids; close() drops them."""

    def __init__(self, scratch: Scratch, fanout: int = FANOUT, buckets: int = LEAST_BUCKETS):
        self.scratch, self.fanout, self.buckets, self.levels = scratch, fanout, buckets, [[]]

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _write(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self.scratch.save_bucketed(run, f"run-{level}", self.buckets, ["h1", "h2"]))

    def append(self, keys: DataFrame) -> None:
        """Adds a batch of (doc_id, h1, h2); an id's rows are all in one batch."""
        batch = keys.distinct().groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        batch = batch.repartition(self.buckets, "h1", "h2")
        with self.scratch.sorted_buckets():
            for i, run in enumerate(self.runs()):
                # What a run holds already has a larger id there, in the one run in which it was new.
                held = run.where("last_doc is not null").select("h1", "h2", F.lit(True).alias(f"held{i}"))
                batch = batch.join(held.hint("merge"), ["h1", "h2"], "left").withColumn("last_doc", F.when(F.col(f"held{i}").isNull(), F.col("last_doc"))).drop(f"held{i}")
            self._write(batch, 0)
            level = 0
            while len(self.levels[level]) >= self.fanout:
                old, self.levels[level] = self.levels[level], []
                self._merge(old, level + 1)
                level += 1

    @staticmethod
    def merged(one: DataFrame, other: DataFrame) -> DataFrame:
        """Two runs in one merge join."""
        sides = [df.select("h1", "h2", F.col("n_docs").alias(f"n{i}"), F.col("last_doc").alias(f"d{i}")) for i, df in enumerate((one, other))]
        both = sides[0].join(sides[1].hint("merge"), ["h1", "h2"], "full_outer")
        return both.select("h1", "h2", (F.coalesce("n0", F.lit(0)) + F.coalesce("n1", F.lit(0))).alias("n_docs"), F.greatest("d0", "d1").alias("last_doc"))

    def _merge(self, runs: list[DataFrame], level: int) -> None:
        """Merges runs pair by pair into one of a level; the results of all but the last pair go again."""
        last = runs[0]
        for run in runs[1:-1]:
            old, last = last, self.scratch.save_bucketed(self.merged(last, run), "merging", self.buckets, ["h1", "h2"])
            self.scratch.drop(old, run)
        self._write(self.merged(last, runs[-1]), level)
        self.scratch.drop(last, runs[-1])

    def frequent(self, min_docs: int) -> DataFrame:
        """(h1, h2, last_doc) of the keys that min_docs documents hold."""
        runs = self.runs()
        if len(runs) > 1:
            with self.scratch.sorted_buckets():
                self.levels = [[] for _ in self.levels]
                self._merge(runs, len(self.levels))
        return self.runs()[0].where(F.col("n_docs") >= min_docs).drop("n_docs")

    def close(self) -> None:
        self.scratch.drop(*self.runs())
        self.levels = [[]]


def dropped_keys(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, dropped): the hashes of the line keys that a document of docs(doc_id, text) loses; few at most a line each."""
    scratch = Scratch(docs.sparkSession, "line_dedup")
    keys = scratch.save(line_hashes(docs, min_points), "keys")
    cuts = keys.agg(F.percentile_approx("doc_id", F.array(*(F.lit(i / batches) for i in range(1, batches))), 1000)).first()[0] if batches > 1 else None
    edges = [None, *sorted(set(cuts or ())), None]
    runs = LineRuns(scratch, fanout, min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-keys.count() // BUCKET_KEYS))))
    for low, high in reversed(list(zip(edges, edges[1:], strict=False))):
        batch = keys
        if low is not None:
            batch = batch.where(F.col("doc_id") > low)
        if high is not None:
            batch = batch.where(F.col("doc_id") <= high)
        runs.append(batch)
    # Written first, so that the join reads two exchanges and Spark can split a line that very many documents hold.
    frequent = scratch.save(runs.frequent(min_docs), "frequent")
    runs.close()
    out = keys.join(frequent, ["h1", "h2"]).where("doc_id < last_doc").groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("dropped"))
    out = scratch.save(out, "dropped")
    scratch.drop(keys, frequent)
    return out


def dedup_lines(docs: DataFrame, min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, names: tuple[str, str, str] = ("text_kept", "n_lines", "n_dropped")) -> DataFrame:
    """docs with the kept text, the lines before dropping and the dropped ones, under `names`.

    It needs columns doc_id and text. Columns of the input that have one of the names are replaced.
    """
    gone = dropped_keys(plain(docs, doc_id="doc_id", text="text"), min_points, min_docs, batches, fanout)
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("dropped").alias("gone"))
    # The input's columns by number inside, so that no name of theirs meets one of the operator's.
    numbered = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.toDF(*numbered.values())
    joined = own.join(gone.hint("merge"), own[numbered["doc_id"]] == gone["gone_id"], "left").drop("gone_id")
    text_at = list(numbered).index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines, losses = [], [], []
            for text, gone in zip(batch.column(text_at).cast(pa.large_binary()), batch.column("gone").to_pylist(), strict=True):
                own = (text.as_py() or b"").split(b"\n")
                kept = own
                if gone:
                    lost = {(x["h1"], x["h2"]) for x in gone}
                    kept = [x for x in own if (k := line_key(x, min_points)) is None or _hash(k) not in lost]
                texts.append(b"\n".join(kept))
                lines.append(len(own))
                losses.append(len(own) - len(kept))
            rest = [n for n in batch.schema.names if n != "gone"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(losses, pa.int64())], names=[*rest, "kept", "lines", "losses"])

    schema = StructType([*own.schema.fields, StructField("kept", StringType()), StructField("lines", LongType()), StructField("losses", LongType())])
    out = joined.mapInArrow(keep, schema)
    return out.select(*(F.col(n).alias(c) for c, n in numbered.items() if c not in names), *(F.col(n).alias(c) for n, c in zip(("kept", "lines", "losses"), names, strict=True)))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text_kept", 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)
), k AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), f AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.*, f.last_doc IS NOT NULL AND k.doc_id <> f.last_doc AS gone FROM k LEFT JOIN f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
