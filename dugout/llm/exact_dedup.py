"""Exact dedup by composable polynomial fingerprints.

A text without its white space is a number in base B, taken modulo two primes below 2^31. Fingerprints compose:
F(xy) = F(x) * B^|y| + F(y). A huge text is therefore cut into chunks that any tasks hash in any order; each chunk's
hash is shifted by the length that follows it, and the shifted hashes add up. Texts of equal length and fingerprint are
then compared chunk by chunk as streams of joined chunk rows; a text that differs from its group's first one starts
another round among those that differ, so a collision never joins two texts.

Edge cases: a null text counts as empty, and empty texts equal each other and all-white-space texts. Rows that repeat
(same id and text) are rows of their own: each counts in group_size and returns. A null id is an id like another; it
sorts after all others when the row that stays is chosen. An empty table gives an empty result. Columns beyond the
named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, Scratch, plain, slices, table

#: Bytes of a chunk, and of the longest text that is hashed in one piece.
CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1_000_003_019, 1_500_450_271)


def _powers(n: int, prime: int, base: int) -> np.ndarray:
    """base^0 ... base^(n-1) mod prime, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    k = 1
    while k < n:
        step = np.uint64(pow(base, k, prime))
        out[k : 2 * k] = out[: min(k, n - k)] * step % np.uint64(prime)
        k *= 2
    return out


class Polynomial:
    """Fingerprints of byte strings, with their composition."""

    def __init__(self, primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES, chunk: int = CHUNK):
        self.primes, self.bases = primes, bases
        self.powers = [_powers(chunk, p, b)[::-1].copy() for p, b in zip(primes, bases, strict=True)]
        self.chunk = chunk

    def hash(self, data: bytes) -> tuple[int, ...]:
        """Of at most `chunk` bytes. Bytes count from 1, so that leading zero bytes matter."""
        x = np.frombuffer(data, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        return tuple(int((x * w[len(w) - len(x) :]).sum()) % p for p, w in zip(self.primes, self.powers, strict=True))

    def shifted(self, hashes: tuple[int, ...], after: int) -> tuple[int, ...]:
        """A chunk's share in the hash of a text that goes on for `after` bytes."""
        return tuple(h * pow(b, after, p) % p for h, p, b in zip(hashes, self.primes, self.bases, strict=True))


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "").cast("binary")


def fingerprints(docs: DataFrame, primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, row_key, n_points, n_bytes, f1, f2, text_sha256) of every row of docs(doc_id, text).

    Texts of up to `chunk` bytes are hashed where they are read. The chunks of longer ones are dealt over all tasks,
    and only their hashes come together.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = base.withColumns({"row_key": F.xxhash64("text"), "n_points": F.length("text").cast("long")})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(primes, bases, chunk)
        for batch in batches:
            for a, z, texts in slices(batch):
                rows = [(len(b), *poly.hash(b), hashlib.sha256(b).hexdigest()) for b in (t.translate(None, BLANKS) for t in texts)]
                cols = list(zip(*rows, strict=True))
                kept = [batch.column(c).slice(a, z - a) for c in ("doc_id", "row_key", "n_points")]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "row_key", "n_points", "n_bytes", "f1", "f2", "text_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    tail = "n_points long, n_bytes long, f1 long, f2 long, text_sha256 string"
    short = keyed.where(F.octet_length("text") <= chunk).mapInArrow(whole, f"doc_id {kind}, row_key long, {tail}")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(primes, bases, chunk)
        for batch in batches:
            rows = [poly.shifted(poly.hash(d), n) for d, n in zip(batch.column("piece").to_pylist(), batch.column("after").to_pylist(), strict=True)]
            kept = [batch.column(c) for c in ("doc_id", "row_key", "n_points", "n_bytes", "text_sha256", "i")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["doc_id", "row_key", "n_points", "n_bytes", "text_sha256", "i", "f1", "f2"])

    long = (
        keyed.where(F.octet_length("text") > chunk)
        .withColumn("normal", _normal(F.col("text")))
        .withColumns({"n_bytes": F.octet_length("normal").cast("long"), "text_sha256": F.sha2("normal", 256)})
        .withColumn("cut", _cut(F.col("normal"), chunk))
        .select("doc_id", "row_key", "n_points", "n_bytes", "text_sha256", F.posexplode("cut").alias("i", "piece"))
        .withColumn("after", F.col("n_bytes") - F.col("i") * chunk - F.octet_length("piece"))
        .repartition("doc_id", "row_key", "i")
        .mapInArrow(pieces, f"doc_id {kind}, row_key long, n_points long, n_bytes long, text_sha256 string, i int, f1 long, f2 long")
        # Equal rows add their chunks together: `times` of them, each with the same sum.
        .groupBy("doc_id", "row_key", "n_points", "n_bytes", "text_sha256")
        .agg(F.sum("f1").alias("s1"), F.sum("f2").alias("s2"), F.count_if(F.col("i") == 0).alias("times"))
        .select("doc_id", "row_key", "n_points", "n_bytes", F.expr(f"(s1 div times) % {primes[0]}").alias("f1"), F.expr(f"(s2 div times) % {primes[1]}").alias("f2"), "text_sha256", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("n"))
        .drop("n")
    )
    return short.unionByName(long)


def _cut(normal: Column, chunk: int) -> Column:
    """A binary column in pieces of `chunk` bytes; one empty piece if there is nothing."""
    last = F.greatest(F.ceil(F.octet_length(normal) / chunk).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(normal, i * chunk + 1, F.lit(chunk)))


def exact_groups(docs: DataFrame, primes: tuple[int, ...] = PRIMES, bases: tuple[int, ...] = BASES, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of docs(doc_id, text).

    Of equal texts, the row with the most code points and then the smallest id stays; of rows that share that id too,
    each says kept.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact_dedup")
    prints = scratch.save(fingerprints(docs, primes, bases, chunk), "fingerprints")
    key = ["n_bytes", "f1", "f2"]
    same = lambda a, b, names: [a[n].eqNullSafe(b[n]) for n in names]

    members = scratch.save(prints.select("doc_id", "row_key", *key).distinct(), "members")
    repeats = members.count() < prints.count()
    several = members.groupBy(*key).agg(F.min(F.struct("doc_id", "row_key")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Written before they are joined, here and below: the join then reads two exchanges, and Spark can split a hot group.
    several = scratch.save(several, "several")
    open_rows = scratch.save(members.join(several, key).select("doc_id", "row_key", *key, "first"), "equal_fingerprints")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", F.xxhash64("text"))
    turned = None  # rows whose text differs from that of their fingerprint's first row, with the round that took them
    turn = 0
    while not open_rows.isEmpty():
        # A merge join at every size: a list of rows that happens to be small would be broadcast, and larger ones not.
        held = texts.join(open_rows.hint("merge"), same(texts, open_rows, ["doc_id", "row_key"])).select(open_rows["doc_id"], open_rows["row_key"], *key, "first", "text")
        stream = held.select("doc_id", "row_key", *key, "first", F.posexplode(_cut(_normal(F.col("text")), chunk)).alias("i", "piece"))
        is_first = F.struct("doc_id", "row_key").eqNullSafe(F.col("first"))
        heads = stream.where(is_first).select(*key, "i", F.col("piece").alias("head"))
        if repeats:
            heads = heads.dropDuplicates([*key, "i"])
        differ = stream.where(~is_first).join(heads, [*key, "i"]).where("piece <> head").select("doc_id", "row_key", *key).distinct()
        turn += 1
        rest = scratch.save(differ, "differ")
        if rest.isEmpty():
            break
        turned = rest.withColumn("turn", F.lit(turn)) if turned is None else turned.join(rest.select("doc_id", "row_key"), ["doc_id", "row_key"], "left_anti").unionByName(rest.withColumn("turn", F.lit(turn)))
        turned = scratch.save(turned, "turned")
        heads_of = rest.groupBy(*key).agg(F.min(F.struct("doc_id", "row_key")).alias("first"))
        open_rows = scratch.save(rest.join(heads_of, key), "open")

    if turned is None:
        classed = prints.withColumn("turn", F.lit(0))
    else:
        moved = turned.select(F.col("doc_id").alias("d"), F.col("row_key").alias("r"), "turn")
        classed = prints.join(moved, prints["doc_id"].eqNullSafe(moved["d"]) & (prints["row_key"] == moved["r"]), "left").withColumn("turn", F.coalesce("turn", F.lit(0))).drop("d", "r")
    group = [*key, "turn"]
    order = F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("u"), "doc_id")
    groups = scratch.save(classed.groupBy(*group).agg(F.min(order).alias("best"), F.count("*").alias("group_size")), "groups")
    scratch.drop_all(prints, groups, *([] if turned is None else [turned]))  # all that the result reads
    return classed.join(groups, group).select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"), "text_sha256")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"))


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm
  FROM documents
), w AS (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
  FROM d
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
