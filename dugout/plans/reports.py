"""Files of a batch: details, ids to read again, a summary. Small results only; details are written by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import quality as Q
from ..operators import reconcile as R


def write_batch(results: DataFrame, path: str) -> None:
    results.write.mode("append").option("header", True).csv(path)


def reprocessing(reports: DataFrame, games: DataFrame, least: float, site: str) -> dict[str, DataFrame]:
    """details, urls, summary and teams of the games below an accuracy."""
    details = Q.low_accuracy(reports, games, least).join(games.select("game_id", "home_team", "away_team"), "game_id")
    spread = [f(c).alias(f"{n}_{c}") for c in ("batting_accuracy", "pitching_accuracy") for n, f in (("low", F.min), ("high", F.max), ("mean", F.avg))]
    return {
        "details": details,
        "urls": details.select("game_id", T.game_url(F.col("game_id").cast("string"), site).alias("url")),
        "summary": details.agg(F.count("*").alias("games"), F.min("game_date").alias("first_date"), F.max("game_date").alias("last_date"), *spread),
        "teams": Q.team_frequency(details),
    }


def discrepancy_table(diffs: DataFrame, keys: list[str], stats: tuple[str, ...]) -> DataFrame:
    """One row for each player that differs, a column for each stat's difference."""
    return diffs.where("diff <> 0").groupBy(*keys).pivot("stat", list(stats)).agg(F.first("diff"))


def as_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))


def text_report(results: DataFrame, diffs: DataFrame) -> DataFrame:
    """(line_no, line): a batch in words: its size, accuracy, the bands, and the stats that differ most."""
    head = results.agg(F.count("*").alias("games"), F.avg("accuracy").alias("mean"), F.min("accuracy").alias("low"))
    lines = F.array(F.format_string("Games: %d", "games"), F.format_string("Mean accuracy: %.2f", "mean"), F.format_string("Lowest accuracy: %.2f", "low"))
    first = head.select(F.posexplode(lines).alias("i", "line")).select(F.struct(F.lit(0).alias("part"), F.col("i").cast("double").alias("i"), F.lit("").alias("name")).alias("place"), "line")
    bands = R.accuracy_histogram(results).select(F.struct(F.lit(1).alias("part"), (-F.col("games")).cast("double").alias("i"), F.col("band").alias("name")).alias("place"), F.format_string("  %s: %d", "band", "games").alias("line"))
    stats = R.discrepancy_histogram(diffs).select(F.struct(F.lit(2).alias("part"), (-F.col("total")).cast("double").alias("i"), F.col("stat").alias("name")).alias("place"), F.format_string("  %s differs by %.0f over %d players", "stat", "total", "players").alias("line"))
    # A few lines: three, six bands, and one for each stat.
    every = first.unionByName(bands).unionByName(stats)
    return every.withColumn("line_no", F.row_number().over(W.orderBy("place"))).select("line_no", "line")
