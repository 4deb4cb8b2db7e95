"""Batting and pitching order from box-score rows, with window functions inside each game and team."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TEAM = ("game_id", "team")


def eligible_batters(rows: DataFrame, all_pitchers: bool = False) -> DataFrame:
    """Without empty names, repeated headers, totals, and pitchers who did not bat, or all pitchers."""
    name = F.coalesce("player_name", F.lit(""))
    header = (name == "") | (F.lower(name) == "batting") | name.contains("Team Totals")
    idle = F.array_contains("positions", "P")
    if not all_pitchers:
        idle = idle & (F.coalesce("PA", F.lit(0)) == 0) & (F.coalesce("AB", F.lit(0)) == 0)
    return rows.where(~header & ~F.coalesce(idle, F.lit(False)))


def batting_order(rows: DataFrame, keys: tuple[str, ...] = TEAM) -> DataFrame:
    """rows(row_idx, positions, is_indented, PA) with batting_order, is_starter, is_substitute.

    Starters count up; a substitute who batted takes the place of the starter before, others have none.
    """
    sub = F.array_contains("positions", "PR") | F.array_contains("positions", "PH") | F.col("is_indented")
    before = W.partitionBy(*keys).orderBy("row_idx").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("is_substitute", F.coalesce(sub, F.lit(False)))
    starters = F.coalesce(F.sum(F.when(F.col("is_substitute"), 0).otherwise(1)).over(before), F.lit(0)).cast("int")
    place = F.when(~F.col("is_substitute"), starters + 1).when(F.coalesce("PA", F.lit(0)) > 0, F.greatest(F.lit(1), starters))
    return rows.withColumn("batting_order", place).withColumn("is_starter", ~F.col("is_substitute"))


def pitching_order(rows: DataFrame, keys: tuple[str, ...] = TEAM) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy("row_idx"))
    return rows.withColumn("pitching_order", place).withColumn("is_starter", place == 1)


def first_nine(rows: DataFrame, keys: tuple[str, ...] = TEAM) -> DataFrame:
    """The first nine who bat, neither pitchers nor pinch runners, as starters with their order."""
    plays = ~F.array_contains("positions", "P") & ~F.array_contains("positions", "PR") & ((F.col("PA") > 0) | (F.col("AB") > 0))
    plays = F.coalesce(plays, F.lit(False))
    place = F.sum(plays.cast("int")).over(W.partitionBy(*keys).orderBy("row_idx"))
    return rows.withColumn("batting_order", F.when(plays & (place <= 9), place.cast("int"))).withColumn("is_starter", F.col("batting_order").isNotNull())


def positional_substitutes(starters: DataFrame, subs: DataFrame, keys: tuple[str, ...] = TEAM) -> DataFrame:
    """subs with the name and order of the starter at the same primary position."""
    primary = F.get("positions", F.lit(0))
    held = starters.select(*keys, primary.alias("position"), "row_idx", F.col("player_name").alias("replaced"), F.col("batting_order").alias("replaced_order"))
    held = held.groupBy(*keys, "position").agg(F.min_by(F.struct("replaced", "replaced_order"), "row_idx").alias("r"))
    return subs.withColumn("position", primary).join(held, [*keys, "position"], "left").select(*subs.columns, F.col("r.replaced").alias("replaced_player"), F.col("r.replaced_order").alias("inherited_order"))


def low_pa_candidate(starters: DataFrame, share: float = 0.7, keys: tuple[str, ...] = TEAM) -> DataFrame:
    """Of each team, the first starter with fewer plate appearances than a share of the starters' mean: a pinch hitter's likely place."""
    mean = F.avg("PA").over(W.partitionBy(*keys))
    return starters.withColumn("mean_pa", mean).where(F.col("PA") < share * F.col("mean_pa")).groupBy(*keys).agg(F.min("batting_order").alias("candidate_order"))


def indexed_order(rows: DataFrame, keys: tuple[str, ...] = TEAM, most: int = 9) -> DataFrame:
    """The first `most` rows as starters, by their place alone."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy("row_idx"))
    return rows.withColumn("batting_order", F.when(place <= most, place)).withColumn("is_starter", place <= most)


def indented_order(rows: DataFrame, keys: tuple[str, ...] = TEAM, most: int = 9) -> DataFrame:
    """batting_order() that ends at `most`, with the kind of substitution."""
    kind = F.when(F.array_contains("positions", "PR"), "pinch_runner").when(F.array_contains("positions", "PH"), "pinch_hitter").when(F.col("is_substitute"), "defensive")
    return batting_order(rows, keys).withColumn("batting_order", F.least("batting_order", F.lit(most))).withColumn("substitution", kind)
