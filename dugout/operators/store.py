"""Keyed writes without keys: inserts, upserts and deletes as plans over Parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def insert_if_absent(stored: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """stored and the rows of new whose key it lacks; of several new rows with a key the first in order of arrival.

    order: columns that say when a row of new came; they need not be stored.
    """
    first = W.partitionBy(*keys).orderBy(*order)
    fresh = new.join(stored.select(*keys), keys, "left_anti").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return stored.unionByName(fresh.select(*(c for c in fresh.columns if c in stored.columns)), allowMissingColumns=True)


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """new over stored; of several new rows with a key the last in order of arrival."""
    last = W.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    latest = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    return stored.join(latest.select(*keys), keys, "left_anti").unionByName(latest.select(*(c for c in latest.columns if c in stored.columns)), allowMissingColumns=True)


def first_of(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the first by order."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def delete_games(tables: dict[str, DataFrame], games: DataFrame) -> dict[str, DataFrame]:
    """The tables without the rows of these games."""
    gone = games.select("game_id").distinct()
    return {name: df.join(gone, "game_id", "left_anti") for name, df in tables.items()}


def delete_season(tables: dict[str, DataFrame], games: DataFrame, season: int) -> dict[str, DataFrame]:
    """The tables, games among them, without a season's rows."""
    return delete_games(tables, games.where(F.col("season") == season))


def deletions(tables: dict[str, DataFrame], games: DataFrame) -> DataFrame:
    """(table_name, n): what delete_games would remove."""
    gone, out = games.select("game_id").distinct(), None
    for name, df in tables.items():
        one = df.join(gone, "game_id", "left_semi").agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def enrich_new_players(stored: DataFrame, seen: DataFrame, bios: DataFrame) -> DataFrame:
    """Players that the store lacks, with their bio where there is one and where it came from."""
    new = seen.join(stored.select("player_id"), "player_id", "left_anti")
    rows = new.join(bios.withColumn("source", F.lit("bio")), "player_id", "left")
    return rows.withColumn("full_name", F.coalesce("full_name", "player_name")).withColumn("source", F.coalesce("source", F.lit("box_score"))).drop("player_name")


def wide_appearances(batting: DataFrame, pitching: DataFrame) -> DataFrame:
    """One row for each game and player with both lines, so that two-way players keep both."""
    keys = ["game_id", "player_id"]
    pitched = pitching.select(*keys, *(F.col(c).alias(f"pitching_{c}") for c in pitching.columns if c not in keys))
    return batting.join(pitched, keys, "full_outer")


def _files(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Writes df beside path and puts it in path's place; if that fails, the old table is put back.

    Between two renames readers find no table. Where that matters, or for tables that belong together, see versions.Store.
    """
    hadoop, path, mark = spark._jvm.org.apache.hadoop.fs.Path, path.rstrip("/"), uuid.uuid4().hex
    staging, aside, fs = f"{path}-{mark}", f"{path}-{mark}-old", _files(spark, path)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(staging)
    had = fs.exists(hadoop(path))
    if had and not fs.rename(hadoop(path), hadoop(aside)):
        raise OSError(f"{path} could not be set aside; the new table is {staging}")
    if not fs.rename(hadoop(staging), hadoop(path)):
        if had and not fs.rename(hadoop(aside), hadoop(path)):
            raise OSError(f"the old table is {aside}, the new one {staging}")
        raise OSError(f"{staging} could not take the place of {path}; the old table stands")
    if had:
        fs.delete(hadoop(aside), True)
