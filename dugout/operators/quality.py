"""Health of the stored tables: orphans, gaps, low accuracies, frequencies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key).distinct(), key, "left_anti")


def health(batting: DataFrame, games: DataFrame, reports: DataFrame) -> DataFrame:
    """(check, n): rows without a game, empty names, games without a date, low accuracies."""
    checks = (
        ("orphan_batting", orphans(batting, games, "game_id").agg(F.count("*").alias("n"))),
        ("empty_names", batting.agg(F.count_if(F.col("player_name").isNull() | (F.col("player_name") == "")).alias("n"))),
        ("games_without_date", games.agg(F.count_if(F.col("game_date").isNull()).alias("n"))),
        ("low_accuracy", reports.agg(F.count_if(F.col("accuracy_percentage") < 95).alias("n"))),
    )
    return reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("check"), "n") for name, df in checks))


def store_summary(batting: DataFrame, pitching: DataFrame, games: DataFrame, reports: DataFrame) -> DataFrame:
    """One row: rows of each table, the dates they span, the mean accuracy of each kind of report."""
    counts = [df.agg(F.count("*").alias(name)) for name, df in (("batting_rows", batting), ("pitching_rows", pitching))]
    dates = games.agg(F.count("*").alias("games"), F.min("game_date").alias("first_date"), F.max("game_date").alias("last_date"))
    mean = lambda t: F.avg(F.when(F.col("validation_type") == t, F.col("accuracy_percentage"))).alias(f"{t}_accuracy")
    parts = [dates, *counts, reports.agg(mean("batting"), mean("pitching"))]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*(F.max(c).alias(c) for c in rows.columns))


def reports_by_game(reports: DataFrame, games: DataFrame) -> DataFrame:
    """Batting and pitching differences side by side, most first."""
    at = lambda t, c: F.max(F.when(F.col("validation_type") == t, F.col(c)))
    out = reports.join(games.select("game_id", "game_date"), "game_id").groupBy("game_id", "game_date").agg(at("batting", "discrepancies_count").alias("batting_diffs"), at("pitching", "discrepancies_count").alias("pitching_diffs"), at("batting", "accuracy_percentage").alias("batting_accuracy"), at("pitching", "accuracy_percentage").alias("pitching_accuracy"))
    return out.withColumn("total_diffs", F.coalesce("batting_diffs", F.lit(0)) + F.coalesce("pitching_diffs", F.lit(0)))


def reports_by_year(reports: DataFrame, games: DataFrame) -> DataFrame:
    rows = reports.join(games.select("game_id", "season"), "game_id")
    with_diffs = F.when(F.col("discrepancies_count") > 0, F.col("game_id"))
    return rows.groupBy("season").agg(F.count_distinct("game_id").alias("games"), F.count_distinct(with_diffs).alias("games_with_diffs"), F.sum("discrepancies_count").alias("diffs"))


def low_accuracy(reports: DataFrame, games: DataFrame, least: float) -> DataFrame:
    low = reports.where(F.col("accuracy_percentage") < least).select("game_id").distinct()
    return reports_by_game(reports, games).join(low, "game_id", "left_semi")


def null_accuracy(reports: DataFrame) -> DataFrame:
    return reports.where(F.col("accuracy_percentage").isNull() | (F.col("accuracy_percentage") == 0)).select("game_id").distinct()


def to_reprocess(reports: DataFrame, games: DataFrame, least: float) -> DataFrame:
    return low_accuracy(reports, games, least).select("game_id").union(null_accuracy(reports)).distinct()


def team_frequency(games: DataFrame, n: int = 10) -> DataFrame:
    teams = games.select(F.col("home_team").alias("team")).union(games.select(F.col("away_team").alias("team")))
    return teams.groupBy("team").agg(F.count("*").alias("games")).orderBy(F.desc("games"), "team").limit(n)


def frequencies(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most and the n least frequent values, marked head and tail."""
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    head = counted.orderBy(F.desc("n"), "value").limit(n).withColumn("end", F.lit("head"))
    return head.unionByName(counted.orderBy("n", "value").limit(n).withColumn("end", F.lit("tail")))


def two_way(batting: DataFrame, pitching: DataFrame) -> DataFrame:
    """Players of a game who batted and pitched."""
    keys = ["game_id", "player_id"]
    return batting.select(*keys).intersect(pitching.select(*keys))


def meaningful(batting: DataFrame, stats: tuple[str, ...]) -> DataFrame:
    """Rows with any of the stats above zero in sum."""
    return batting.where(sum((F.coalesce(F.col(s), F.lit(0)) for s in stats if s in batting.columns), F.lit(0)) > 0)
