"""Temperature mixing of sources.

Weights are the sources' token shares to the power of an exponent, normalised. An exponent of 1 keeps the shares, one of
0 makes them equal. The exponent is bisected until the weights have a target entropy, or as low as the repetition limit
allows. Four halvings are one Spark job: the sums of p^a and p^a * log p over the table of sources, for the 15 exponents
that they can visit.

Weights become rows by budgeted block permutations. The documents of a source are dealt by hash into blocks of about
`block_tokens` tokens, or a BLOCKS-th of its tokens if that is less, so that small sources are cut as finely as large
ones. Each epoch orders the blocks by a hash of its own; full epochs take all of them, and of the last,
partial one come the blocks whose middle lies within what is left of the source's budget: shares are met to within
half a block, or half a document that is longer. Running totals go over ranges of the permutation and inside each range, so that no
task holds all blocks of a large source. A row's position, the share of
its source's budget used before it, interleaves all sources at their weights. Without a budget it is the least one that
cuts no source, so every document appears at least once.

Edge cases: a null source is a source of its own, as is an empty one apart from it. Sources without tokens have no
weight; their documents appear once. Rows that repeat an id lie in one block and appear each. A null id is an id like
another: such rows lie in one block. One source has weight 1. An empty table gives an empty result. Columns of the input are carried through
mix() unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Scratch, n_tokens, plain, table

BLOCK_TOKENS, BLOCKS = 1 << 16, 1024
#: Blocks of a source that one task orders, on average.
RANGE = 8192
#: Rows of a plan, some 30 bytes each, that go to all tasks; a longer one is joined by a shuffle of the documents.
MOST_SENT = 1 << 20
REPETITION = 2.0
SEED = 20


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """(sum of p^a, sum of p^a * log p) for each exponent, over shares(p)."""
    powers = [x for a in exponents for x in (F.sum(F.pow("p", F.lit(a))), F.sum(F.pow("p", F.lit(a)) * F.log("p")))]
    row = shares.agg(*(x.alias(f"x{i}") for i, x in enumerate(powers))).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]


def entropy(a: float, z: float, zl: float) -> float:
    """Of the weights p^a / z, where zl is the sum of p^a * log p."""
    return math.log(z) - a * zl / z


def exponent(shares: DataFrame, target_entropy: float | None = None, repetition: float | None = REPETITION, budget_share: float | None = None, jobs: int = 6) -> float:
    """The exponent from 0 to 1 whose weights meet a target entropy, or the least within the repetition limit.

    budget_share is the budget over all tokens; None is the least that cuts no source. Both measures fall as the
    exponent rises, so a target that no exponent meets gives the nearest end.
    """
    least, most = shares.agg(F.min("p"), F.max("p")).first()
    if least is None or least == most:
        return 1.0

    def too_flat(a: float, z: float, zl: float) -> bool:
        if target_entropy is not None:
            return entropy(a, z, zl) > target_entropy
        repeated = (most / least) ** (1 - a) if budget_share is None else budget_share * least ** (a - 1) / z
        return repeated > repetition

    low, high = 0.0, 1.0
    for i in range(jobs):
        tried = [low + (high - low) * k / 16 for k in range(0 if i == 0 else 1, 16)]
        flat = {a: too_flat(a, *s) for a, s in zip(tried, _sums(shares, tried), strict=True)}
        if i == 0 and not flat.pop(0.0):
            return 0.0
        span = (low, high)
        at, step = 0, 8
        while step:  # four halvings, each looking up one exponent
            if flat[span[0] + (span[1] - span[0]) * (at + step) / 16]:
                at += step
            step //= 2
        low, high = span[0] + (span[1] - span[0]) * at / 16, span[0] + (span[1] - span[0]) * (at + 1) / 16
    return high


def mixing_plan(counted: DataFrame, target_entropy: float | None = None, repetition: float | None = REPETITION, budget: int | None = None, block_tokens: int = BLOCK_TOKENS, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(sources, plan) of counted(doc_id, source, n_tokens).

    sources: (source, tokens, blocks, weight, repeats); plan: (source, block, epoch, position).
    """
    scratch = scratch or Scratch(counted.sparkSession, "mixing")
    sums = scratch.save(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "sums")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    share = budget / total if budget and total else None
    p = F.col("tokens") / float(total or 1)
    shares = sums.where("tokens > 0").select(p.alias("p"))
    a = exponent(shares, target_entropy, repetition, share)
    (z, _), top = _sums(shares, [a])[0] if total else (1.0, 0.0), (shares.agg(F.max("p")).first()[0] or 1.0)
    # Both forms of budget times weight over tokens; the first is exactly 1 for the largest source.
    repeats = F.pow(top / p, F.lit(1 - a)) if share is None else share * F.pow(p, F.lit(a - 1)) / z
    sources = scratch.save(
        sums.select(
            "source",
            "tokens",
            F.greatest(F.ceil(F.col("tokens") / F.least(F.lit(block_tokens), F.greatest(F.ceil(F.col("tokens") / BLOCKS), F.lit(1)))), F.lit(1)).cast("long").alias("blocks"),
            F.when(F.col("tokens") > 0, F.pow(p, F.lit(a)) / z).otherwise(0.0).alias("weight"),
            F.when(F.col("tokens") > 0, repeats).otherwise(1.0).alias("repeats"),
        ),
        "sources",
    )
    held = with_blocks(counted, sources).groupBy("source", "block", "blocks").agg(F.sum("n_tokens").alias("n"))
    held = held.join(sources.drop("blocks", "weight").withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    epochs = held.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil("repeats").cast("int") - 1, F.lit(0)))))
    # A permutation's place is a hash; equal parts of its values are the ranges.
    epochs = epochs.withColumn("at", F.pmod(F.xxhash64(F.lit(SEED), "epoch", "source", "block"), F.lit(1 << 40)))
    epochs = epochs.withColumn("range", F.shiftright(F.col("at") * F.ceil(F.col("blocks") / RANGE), 40))
    epochs = scratch.save(epochs, "epochs")
    parts = epochs.groupBy("source", "epoch", "range").agg(F.sum("n").alias("n"))
    above = parts.select(F.col("source").alias("of"), F.col("epoch").alias("e"), F.col("range").alias("r"), (F.sum("n").over(W.partitionBy("source", "epoch").orderBy("range")) - F.col("n")).alias("above"))
    order = W.partitionBy("source", "epoch", "range").orderBy("at", "block")
    inside = epochs.withColumn("before", F.sum("n").over(order) - F.col("n"))
    placed = inside.join(above, F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("e")) & (F.col("range") == F.col("r"))).withColumn("before", F.col("before") + F.col("above"))
    left = (F.col("repeats") - F.col("epoch")) * F.col("tokens")
    taken = placed.where((F.col("repeats") >= F.col("epoch") + 1) | (F.col("before") + F.col("n") / 2 <= left))
    position = (F.col("epoch") + F.when(F.col("tokens") > 0, F.col("before") / F.col("tokens")).otherwise(0.0)) / F.col("repeats")
    plan = scratch.save(taken.select("source", "block", "epoch", position.alias("position")), "plan")
    scratch.drop(sums, epochs)
    return sources, plan


def with_blocks(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """docs with blocks, their source's number, and block. Only sources and numbers come along from sources."""
    known = sources.select(F.col("source").alias("_source"), "blocks")
    joined = docs.join(known, docs["source"].eqNullSafe(known["_source"])).drop("_source")
    return joined.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.col("blocks")))


def mix(docs: DataFrame, counted: DataFrame, names: tuple[str, str] = ("mix_epoch", "mix_position"), **options) -> DataFrame:
    """Rows of docs as often as their source's weight asks, with epoch and position under `names`.

    counted: (doc_id, source, n_tokens) of the same rows; docs needs the columns doc_id and source. Columns of docs that
    have one of the names are replaced.
    """
    sources, plan = mixing_plan(counted, **options)
    # With a short plan, counted first, the documents stay where they are.
    sent = F.broadcast if plan.count() <= MOST_SENT else lambda df: df
    numbered = {c: c if c in ("doc_id", "source") else f"c{i}" for i, c in enumerate(docs.columns)}
    blocked = with_blocks(docs.toDF(*numbered.values()), sources)
    plan = sent(plan.select(F.col("source").alias("of"), F.col("block").alias("at"), "epoch", "position"))
    mixed = blocked.join(plan, blocked["source"].eqNullSafe(plan["of"]) & (blocked["block"] == plan["at"]))
    return mixed.select(*(F.col(n).alias(c) for c, n in numbered.items() if c not in names), *(F.col(n).alias(c) for n, c in zip(("epoch", "position"), names, strict=True)))


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = plain(table(spark, sf_dir, "documents"), doc_id="doc_id", source="source", text="text")
    counted = Scratch(spark, "mixing").save(docs.select("doc_id", "source", n_tokens(F.col("text")).alias("n_tokens")), "counted")
    return mix(counted, counted, names=("epoch", "position"))
