"""The corpus pipeline: language ID, line dedup, near-dedup, mixing and packing, each over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.llm import language_id, line_dedup, minhash_dedup, mixing, packing
from dugout.llm.common import Scratch, n_tokens, plain, table

#: Word shingles of near-duplicates, and their least similarity in percent.
WORDS, PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known well enough."""
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another one keeps."""
    inner = ("text", "~lines", "~dropped")
    out = line_dedup.dedup_lines(docs, names=inner).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(f"`{c}`" for c in docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least id."""
    judged = minhash_dedup.components(plain(docs, doc_id="doc_id", text="text"), WORDS, PERCENT)
    gone = Scratch(spark, "pipeline").save(judged.where("not kept").select(F.col("doc_id").alias("_gone")).distinct(), "near_duplicates")
    # A merge join at every size, so that the plan does not depend on how many go.
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["_gone"], "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture asks; the budget cuts no source, so each appears at least once."""
    counted = Scratch(spark, "pipeline").save(docs.select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens")), "counted")
    return mixing.mix(docs, counted, names=("~epoch", "~position")).select(*(f"`{c}`" for c in docs.columns))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's pieces in length buckets and batches."""
    return packing.pack(plain(docs, doc_id="doc_id", text="text"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before is not None:
            scratch.drop(before)
        before = docs
    out = STAGES[-1][1](spark, docs, sf_dir)
    scratch.drop(docs)  # packing has written the pieces that its result reads
    return out


#: Language models, bisection and dynamic programming are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
