"""Near-dedup by b-bit MinHash, with every link confirmed on full shingle sets.

1. signatures(): the distinct word shingles of each text (64-bit hashes), K minima over them, band keys from the whole
   minima, the low B bits of each minimum packed into longs, and a histogram of the set over CELLS cells. Documents of
   equal sets become one class; from here on only classes are linked.
2. Bands: classes that share a band key are in a bucket. With 32 bands of 4 minima a pair of similarity 0.8 shares none
   with a chance of 5e-8, one of 0.85 with 6e-11.
3. Stars: each class meets the best-looking of the smallest ids of its buckets, and the pair is confirmed by the
   intersection of the full sets. This joins nearly all copies.
4. The rest: in each bucket that still has several components, classes outside its largest one meet all classes of other
   components, in blocks that hold the full sets. The bit counts of the packed signatures give a collision-corrected
   estimate that puts likely links first and leaves out pairs with too few equal minima (a true link has so few with a
   chance of LOSS, far below the bands'); histograms prove of most others that they cannot reach the threshold; what is
   left is intersected on the spot. A block joins the components that it links and writes no more than the links that
   joined some, so however many near misses there are, they are neither written nor moved. A pair is met in the least of
   its common buckets only.

So no bucket is capped, no pairs of a group are written out, and the components are those of the full link graph.

Edge cases: a null text, or one without words, has no shingles and is linked with nothing, itself a component; with
fewer words than a shingle has, the whole sequence is one shingle. Rows that repeat an id are judged by the same id:
they return once each, with that id's component; if their texts differ, the one with the least digest speaks for the
id. Rows without an id link nothing and return with a null component and kept true. An empty table gives an empty result. Columns beyond the
named ones are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, plain, slices, table
from .components import connected_components

MINIMA, BANDS, BITS, CELLS = 128, 32, 2, 256
#: The chance that a pair at the threshold has too few equal minima to be intersected.
LOSS = 1e-12
#: A block has the square root of its bucket's classes times SPREAD, LEAST_BLOCK at least, and about BLOCK_BYTES of sets.
LEAST_BLOCK, SPREAD, BLOCK_BYTES = 512, 16, 64 << 20

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 2**64)
_PLACE = _rng.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _rng.integers(1, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, 1024, dtype=np.uint64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LONG_WORD = 64


def _series(ratio: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    k = 1
    while k < n:
        out[k : 2 * k] = out[: min(k, n - k)] * np.uint64(pow(ratio, k, 2**64))
        k *= 2
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, A-Z lower-cased, and each text's first word with one end more."""
    data = b" ".join(texts) + b" "
    raw = np.frombuffer(data, dtype=np.uint8)
    space = _SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * _series(_BASE, len(raw)), out=total[1:])
        words = mix((total[ends] - total[starts]) * _series(_UNBASE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        words[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].lower())
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    return words, np.searchsorted(starts, offsets)


def shingle_hashes(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = word_hashes(texts)
    n = len(hashes)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, dtype=np.uint64)
        for j in range(min(words, n)):
            rolled[: n - j] += hashes[j:] * _PLACE[j]
        rolled = mix(rolled)
        out = []
        for a, z in zip(first[:-1], first[1:], strict=True):
            if z - a >= words:
                own = np.unique(rolled[a : z - words + 1])
            elif z > a:  # the whole sequence; its length keeps it apart from full shingles
                own = mix((hashes[a:z] * _PLACE[: z - a]).sum(keepdims=True) + np.uint64(z - a))
            else:
                own = np.zeros(0, dtype=np.uint64)
            out.append(own)
    return out


def minima(sets: list[np.ndarray], k: int = MINIMA) -> np.ndarray:
    """k minima of each non-empty set: shape (sets, k)."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), k), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out[:, i] = np.minimum.reduceat(flat * _A[i] + _B[i], starts)
    return out


def pack(minimum: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low bits of the mixed minima, packed into 64-bit words."""
    low = mix(minimum) & np.uint64(2**bits - 1)
    per = 64 // bits
    out = np.zeros((len(low), low.shape[1] // per), dtype=np.uint64)
    for i in range(low.shape[1]):
        out[:, i // per] |= low[:, i] << np.uint64(bits * (i % per))
    return out


def estimate(a: np.ndarray, b: np.ndarray, k: int = MINIMA, bits: int = BITS) -> np.ndarray:
    """Similarity from packed signatures (rows of a against rows of b), corrected for chance collisions of low bits."""
    differ = a ^ b
    any_bit = differ.copy()
    for i in range(1, bits):
        any_bit |= differ >> np.uint64(i)
    mask = np.uint64(sum(1 << (bits * i) for i in range(64 // bits)))
    unequal = np.bitwise_count(any_bit & mask).sum(axis=-1, dtype=np.int64)
    chance = 0.5**bits
    return ((1 - unequal / k) - chance) / (1 - chance)


def least_estimate(threshold: float, k: int = MINIMA, bits: int = BITS) -> float:
    """The estimate below which a pair at the threshold comes out with a chance of at most LOSS (binomial, exact)."""
    chance = 0.5**bits
    match = threshold + (1 - threshold) * chance
    equal, below = 0, (1 - match) ** k
    while below <= LOSS:
        equal += 1
        below += math.comb(k, equal) * match**equal * (1 - match) ** (k - equal)
    return (equal / k - chance) / (1 - chance) - 1e-9


def _histogram(own: np.ndarray) -> bytes:
    """Counts of a set's hashes in CELLS cells; in bytes if they fit, else in four bytes each."""
    counts = np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=CELLS)
    return counts.astype(np.uint8 if counts.max(initial=0) < 256 else np.uint32).tobytes()


def _counts(histograms: list[bytes]) -> np.ndarray:
    """A row for each histogram."""
    if all(len(h) == CELLS for h in histograms):
        return np.frombuffer(b"".join(histograms), dtype=np.uint8).reshape(-1, CELLS)
    return np.stack([np.frombuffer(h, dtype=np.uint8 if len(h) == CELLS else np.uint32).astype(np.uint32) for h in histograms])


_SIGNED = "doc_id {kind}, n_shingles long, digest binary, bands array<long>, packed binary, cells binary"


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, packed, cells) of docs(doc_id, text); an empty set has a null digest."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, texts in slices(batch):
                sets = shingle_hashes(texts, words)
                full = [i for i, s in enumerate(sets) if len(s)]
                digest, bands, packed, cells = ([None] * (z - a) for _ in range(4))
                if full:
                    low = minima([sets[i] for i in full])
                    rows = MINIMA // BANDS
                    with np.errstate(over="ignore"):
                        keys = mix((low.reshape(len(full), BANDS, rows) * _PLACE[:rows]).sum(axis=2) + np.arange(BANDS, dtype=np.uint64) * _PLACE[15]).view(np.int64)
                    bits = pack(low)
                    for j, i in enumerate(full):
                        digest[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
                        bands[i] = keys[j]
                        packed[i] = bits[j].tobytes()
                        cells[i] = _histogram(sets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, z - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary()), pa.array(cells, pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "bands", "packed", "cells"],
                )

    return docs.select("doc_id", "text").mapInArrow(sign, _SIGNED.format(kind=docs.schema["doc_id"].dataType.simpleString()))


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, digest, shingles array<long>)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, z, texts in slices(batch):
                sets = shingle_hashes(texts, words)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, z - a), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["doc_id", "digest", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digest binary, shingles array<long>")


def _first_pairs(members: DataFrame, buckets: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """(a, b): each class with the best-looking of the smallest ids of its buckets."""
    stars = members.join(buckets.select("bucket", "leader"), "bucket").where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b"), F.col("packed").alias("pb")).distinct()
    left = signed.select(F.col("id").alias("a"), F.col("packed").alias("pa"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(n, -1) for c in ("pa", "pb"))
                look = estimate(x, y)
                kept = pa.array(look >= least)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(look, pa.float64())], names=["a", "b", "look"]).filter(kept)

    judged = stars.join(left, "a").select("a", "b", "pa", "pb").mapInArrow(judge, "a long, b long, look double")
    return judged.groupBy("b").agg(F.max_by("a", F.struct("look", -F.col("a"))).alias("a")).select("a", "b")


class _Joined:
    """Components that a block has joined."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, comp: int) -> int:
        while (over := self.up.get(comp, comp)) != comp:
            self.up[comp] = self.up.get(over, over)
            comp = over
        return comp

    def join(self, a: int, b: int) -> None:
        self.up[max(a, b)] = min(a, b)


def _meet(rows: pa.Table, percent: int, least: float) -> list[tuple[int, int]]:
    """The links of one block that join components: its rows of side 0 against those of side 1."""
    side = rows.column("side").to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return []
    every = {c: rows.column(c).to_numpy() for c in ("id", "comp", "n_shingles", "rest")}
    bucket, buckets = rows.column("bucket")[0].as_py(), rows.column("buckets").to_pylist()
    bits = np.frombuffer(b"".join(rows.column("packed").to_pylist()), dtype=np.uint64).reshape(len(rows), -1)
    cells = _counts(rows.column("cells").to_pylist())
    shingles = rows.column("shingles").combine_chunks()
    shingles = shingles.chunk(0) if isinstance(shingles, pa.ChunkedArray) else shingles
    starts, values = shingles.offsets.to_numpy(), shingles.values.to_numpy()
    ids, size, in_rest = every["id"][right], every["n_shingles"][right], every["rest"][right]
    joined, roots, links = _Joined(), every["comp"][right].copy(), []
    for r in left:
        i, n, own = every["id"][r], every["n_shingles"][r], joined.root(int(every["comp"][r]))
        # Two of the rest meet once, seen from the larger id.
        at = np.flatnonzero((roots != own) & (~in_rest | (ids < i)) & (100 * np.minimum(size, n) >= percent * np.maximum(size, n)))
        if not len(at):
            continue
        look = estimate(bits[r][None, :], bits[right[at]])
        at, look = at[look >= least], look[look >= least]
        if not len(at):
            continue
        most = np.minimum(cells[right[at]], cells[r]).sum(axis=1, dtype=np.int64)
        can = 100 * most >= percent * (size[at] + n - most)
        at = at[can][np.argsort(-look[can], kind="stable")]
        mine, met = values[starts[r] : starts[r + 1]], set(buckets[r])
        for j in at:
            other, comp = int(right[j]), int(roots[j])
            if comp == own or min(met.intersection(buckets[other])) != bucket:
                continue
            both = len(np.intersect1d(mine, values[starts[other] : starts[other + 1]], assume_unique=True))
            if 100 * both >= percent * (n + size[j] - both):
                links.append((int(ids[j]), int(i)))
                joined.join(own, comp)
                kept = joined.root(own)
                roots[(roots == own) | (roots == comp)] = kept
                own = kept
    return links


def _rest_links(members: DataFrame, comps: DataFrame, sets: DataFrame, percent: int, least: float, scratch: Scratch) -> DataFrame:
    """(a, b): links between the components of members(bucket, id) that join them.

    Blocks of a bucket are cut by size; a task streams through its blocks and holds one of them at a time.
    """
    placed = scratch.save(members.select("bucket", "id", "n_shingles").join(comps, "id"), "placed")
    sizes = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held")).groupBy("bucket")
    sizes = sizes.agg(F.sum("n").alias("n"), F.sum("held").alias("held"), F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps")).where("comps > 1")
    blocks = F.greatest(F.ceil(F.col("n") / F.greatest(F.lit(LEAST_BLOCK), SPREAD * F.sqrt("n"))), F.ceil(8 * F.col("held") / BLOCK_BYTES)).cast("int")
    # Written first, so that the join reads two exchanges and Spark can split a bucket with many classes.
    sizes = scratch.save(sizes.select("bucket", "main", blocks.alias("blocks")), "sizes")
    sized = placed.drop("n_shingles").join(sizes, "bucket").withColumn("rest", F.col("comp") != F.col("main"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    number, own = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), F.col("block")
    columns = ["bucket", "id", "comp", "rest"]
    left = sized.where("rest").select(*columns, F.lit(0).alias("side"), own.alias("x"), number.alias("y"))
    right = sized.select(*columns, F.lit(1).alias("side"), number.alias("x"), own.alias("y"))
    known = members.groupBy("id").agg(F.collect_set("bucket").alias("buckets"), F.first("packed").alias("packed"), F.first("cells").alias("cells"), F.first("n_shingles").alias("n_shingles"))
    known = known.join(sets.withColumnRenamed("doc_id", "id"), "id")
    dealt = left.unionByName(right).join(known, "id").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = [table.column(c).to_numpy() for c in ("bucket", "x", "y")]
            edges = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
            for a, z in zip([0, *edges], [*edges, table.num_rows], strict=True):
                found = _meet(table.slice(a, z - a).combine_chunks(), percent, least)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], names=["a", "b"])

        held = None  # rows of the block that is not complete yet
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.Table.from_batches([batch])
            held = here if held is None else pa.concat_tables([held, here])
            key = [held.column(c).to_numpy() for c in ("bucket", "x", "y")]
            last = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
            if len(last):
                yield from links(held.slice(0, last[-1] + 1))
                held = held.slice(last[-1] + 1)
        if held is not None and held.num_rows:
            yield from links(held)

    return dealt.mapInArrow(stream, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) by the full sets: 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), shared.alias("both")).select("a", "b", (100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).alias("linked"))


def components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of docs(doc_id long, text): linked at 100 * |A and B| >= percent * |A or B|."""
    scratch = Scratch(docs.sparkSession, "minhash_dedup")
    least = least_estimate(percent / 100)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    every = scratch.save(signatures(docs, words), "signatures")
    known = every.where("digest is not null and doc_id is not null")
    repeats = not known.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    if repeats:
        known = known.groupBy("doc_id").agg(F.min_by(F.struct("n_shingles", "digest", "bands", "packed", "cells"), "digest").alias("r")).select("doc_id", "r.*")

    classes = scratch.save(known.groupBy("digest").agg(F.min_by(F.struct("doc_id", "n_shingles", "bands", "packed", "cells"), "doc_id").alias("r")).select(F.col("r.doc_id").alias("id"), "digest", "r.n_shingles", "r.bands", "r.packed", "r.cells"), "classes")
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    # Buckets of the same classes, as the bands of near-copies have many, count once: their ids' hashes tell.
    seals = [F.bit_xor(F.xxhash64(F.lit(i), "id")).alias(f"seal{i}") for i in (1, 2)]
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("leader"), *seals).where("n > 1")
    buckets = scratch.save(buckets.groupBy("n", "leader", "seal1", "seal2").agg(F.min("bucket").alias("bucket")), "buckets")
    # Nothing follows this join in its stage, so that Spark can split a bucket with many classes.
    shared = scratch.save(banded.join(buckets.select("bucket"), "bucket", "left_semi"), "shared")
    met = shared.select("id").distinct()
    signed = scratch.save(classes.join(met, "id", "left_semi").select("id", "packed", "cells", "n_shingles"), "signed")
    members = scratch.save(shared.join(signed, "id"), "members")

    # Full sets only of the classes that meet another one.
    texts = docs.join(met.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id", "left_semi")
    sets = full_sets(texts, words)
    if repeats:
        sets = sets.groupBy("doc_id").agg(F.min_by("shingles", "digest").alias("shingles"))
    sets = scratch.save(sets.select("doc_id", "shingles"), "sets")

    judged = scratch.save(_confirmed(_first_pairs(members, buckets, signed, least), sets, percent), "judged")
    stars = judged.where("linked").select("a", "b")
    nodes = signed.select("id")
    comps = scratch.save(connected_components(nodes, stars, scratch), "stars")
    rest = scratch.save(_rest_links(members, comps, sets, percent, least, scratch), "rest")
    if not rest.isEmpty():
        comps = connected_components(nodes, stars.unionByName(rest), scratch)
    comps = scratch.save(comps, "components")
    scratch.drop_all(every, classes, comps)
    by_class = classes.select("id", "digest").join(comps, "id", "left").select("digest", F.coalesce("comp", "id").alias("comp"))
    if repeats:
        by_id = known.select("doc_id", "digest").join(by_class, "digest").select("doc_id", "comp")
        out = every.join(by_id, "doc_id", "left")
    else:
        out = every.join(by_class, "digest", "left")
    own = F.coalesce(F.col("comp"), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"), words=3, percent=85)


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) >= 3 THEN unnest(list_transform(range(1, greatest(len(ws) - 1, 2)), lambda i: ws[i] || ' ' || coalesce(ws[i + 1], '') || ' ' || coalesce(ws[i + 2], ''))) ELSE array_to_string(ws, ' ') END AS shingle
  FROM w WHERE len(ws) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), e AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c.both >= 85 * (p.n + q.n - c.both)
), r AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, e.y FROM r JOIN e ON r.y = e.x
), k AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN k ON k.doc_id = d.doc_id
"""
