"""Ranked lexical search over a table of postings.

A document's terms become postings (row, doc_id, n, bucket, term, tf), of the terms that an item asks for. Postings are
bucketed twice: by the row they come from, which is how they lie in files, and inside each file by term, with a bucket
number of the term first, so that a term is one range of each file and statistics skip what isn't asked. A term that a
third of the documents hold is thus spread over all files, and all matches of a document are made in the task that sums
them up: after the join of item terms (small: Spark broadcasts them after checking their size; large: a merge join) each
match gets its integer score, a groupBy of item and row sums them without another exchange, and the window that ranks an
item's documents is cut to the best few in each task before rows move.

Weights come from all documents: N and L in one pass, df by aggregating the postings.

Edge cases: every row of documents is a document, also where rows repeat an id: they rank apart, the earlier one in the table
first. A null text has no terms and isn't counted in N. Rows of one item_id (null is one too) are one item, whose terms
count once. Equal scores go by ascending doc_id, null ids last. An item without terms, or whose terms no document holds, has
no rows; empty tables give none. Columns beyond the named ones aren't read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, plain, slices, table

#: Signs that part terms; every other sign, and all beyond ASCII, belong to one. Only A-Z is lower-cased.
GAP = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
TOP = 10
#: Files of postings: the least and most, and the terms of a table for which there is one. Buckets of terms in a file.
LEAST_FILES, MOST_FILES, FILE_TERMS = 12, 1 << 16, 1 << 22
TERM_BUCKETS = 64
#: Terms of a block of items, with repeats; one item of more makes its block larger.
ITEM_TERMS = 1 << 19


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return text.translate(_SIGNS).split()


def sizes(docs: DataFrame) -> tuple[int, int]:
    """(N, L) of docs(text): documents with a term, and all terms with repeats."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(terms(t)) for _, _, texts in slices(batch) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], names=["docs", "terms"])

    total = docs.select("text").mapInArrow(read, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return total[0] or 0, total[1] or 0


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of items(item_id, text), each once."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return items.select("item_id", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(f"[^{GAP}]+"), F.lit(0)))).alias("term")).distinct()


def postings(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n, bucket, term, tf) of docs(doc_id, text): a row for each document and term of it.

    row tells the rows of docs apart; it holds for one run over docs, so postings have to be written before they are used.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in slices(batch):
                counted = [Counter(terms(t)) for t in texts]
                places = pa.array([i for i, c in enumerate(counted) for _ in c], pa.int64())
                n = pa.array([c.total() for c in counted], pa.int64()).take(places)
                own = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [own.column("row").take(places), own.column("doc_id").take(places), n, pa.array([t for c in counted for t in c], pa.binary()).cast(pa.string()), pa.array([k for c in counted for k in c.values()], pa.int64())],
                    names=["row", "doc_id", "n", "term", "tf"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(read, f"row long, doc_id {kind}, n long, term string, tf long")
    return rows.withColumn("bucket", F.pmod(F.hash("term"), F.lit(TERM_BUCKETS)))


def write_postings(scratch: Scratch, docs: DataFrame, asked: DataFrame, n_terms: int) -> DataFrame:
    """The postings of the asked terms, or of all if very many are asked, as a table of bucketed files."""
    files = min(MOST_FILES, max(LEAST_FILES, n_terms // FILE_TERMS))
    held = postings(docs)
    if asked.count() <= ITEM_TERMS:
        held = held.join(F.broadcast(asked.select("term")), "term", "left_semi")
    return scratch.save_bucketed(held.repartition(files, "row"), "postings", files, ["row"], order=["bucket", "term"])


def weights(posted: DataFrame, n_docs: int) -> DataFrame:
    """(term, w) of postings: the thousandfold logarithm, rounded down, of how rare a term is."""
    df = posted.groupBy("term").agg(F.count("*").alias("df"))
    rare = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return df.select("term", F.floor(1000 * F.log(rare)).cast("long").alias("w"))


def ranked(posted: DataFrame, weighted: DataFrame, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best documents for each item of weighted(item_id, term, w), one block of items."""
    matches = posted.join(F.broadcast(weighted), "term")
    length = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    scored = matches.withColumn("m", length).withColumn("score", F.expr("w * ((1000000000L * tf) div (1000 * tf + 8 * m))"))
    summed = scored.groupBy("item_id", "row", "doc_id").agg(F.sum("score").alias("score")).where("score > 0")
    best = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return summed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def blocks(weighted: DataFrame, most: int = ITEM_TERMS) -> list[DataFrame]:
    """weighted(item_id, term, w) in blocks of about `most` rows, all of an item's in one."""
    n = -(-weighted.count() // most)
    return [weighted] if n < 2 else [weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i) for i in range(n)]


def search(scratch: Scratch, docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of docs(doc_id, text) for items(item_id, text)."""
    n_docs, n_terms = sizes(docs)
    asked = scratch.save(item_terms(items), "asked")
    posted = write_postings(scratch, docs, asked.select("term").distinct(), n_terms)
    weighted = scratch.save(asked.join(weights(posted, n_docs), "term"), "weighted")
    found = (ranked(posted, block, n_docs, n_terms, top) for block in blocks(weighted))
    out = scratch.save(reduce(DataFrame.unionByName, found), "ranked")
    scratch.drop(asked, posted, weighted)
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    items = plain(table(spark, sf_dir, "benchmark"), item_id="item_id", text="text")
    return search(Scratch(spark, "op12"), docs, items)


_TERMS = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{GAP}]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_all FROM d WHERE len(ts) > 0),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, s GROUP BY term, n_docs),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
m AS (SELECT item_id, r, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_all))) AS x FROM i JOIN w USING (term) JOIN p USING (term), s),
g AS (SELECT item_id, r, doc_id, CAST(sum(x) AS BIGINT) AS score FROM m GROUP BY ALL HAVING sum(x) > 0),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, doc_id, score FROM g)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
