"""Schemas of the stored tables; keys are checked, not declared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.versions import Keyed, Store

TABLES = {
    "players": "player_id string, full_name string, bats string, throws string, birth_date date, debut_date date, height_inches int, weight_lbs int",
    "games": "game_id string, game_date date, game_time string, home_team string, away_team string, runs_home_team int, runs_away_team int, winner string, loser string, venue string, is_playoff boolean, playoff_round string, innings_played int, season int",
    "batting_appearances": "game_id string, player_id string, player_name string, team string, batting_order int, positions array<string>, is_starter boolean, is_substitute boolean, PA int, AB int, H int, R int, RBI int, BB int, SO int, HR int, doubles int, triples int, SB int, CS int, HBP int, GDP int, SF int, SH int",
    "pitching_appearances": "game_id string, player_id string, player_name string, team string, is_starter boolean, pitching_order int, decisions array<string>, BF int, H int, R int, ER int, BB int, SO int, HR int, IP decimal(4,1), PC int",
    "events": "event_id string, game_id string, inning int, inning_half string, event_order int, batter_id string, pitcher_id string, description string, is_plate_appearance boolean, is_at_bat boolean, is_hit boolean, hit_type string, is_walk boolean, is_strikeout boolean, is_sacrifice_fly boolean, is_sacrifice_hit boolean, is_out boolean, outs_recorded int, bases_reached int, pitch_count int",
    "validation_reports": "game_id string, validation_type string, status string, accuracy_percentage double, discrepancies_count int",
}
KEYS = {"players": ["player_id"], "games": ["game_id"], "batting_appearances": ["game_id", "player_id"], "pitching_appearances": ["game_id", "player_id"], "events": ["event_id"], "validation_reports": ["game_id", "validation_type"]}


#: A game's season, out of its id.
SEASON = "substring(game_id, 4, 4)"


def _of_game(*keys: str, keeps: str = "old", parents: tuple[tuple[str, str], ...] = (("games", "game_id"),)) -> Keyed:
    return Keyed(keys, SEASON, keeps, parents, "game_id")


#: What the season plan stores. Games and reports are replaced by new ones, other rows stay as they came first. An appearance
#: is a player's in a game and on a side; one whose player has no id is told by the name.
STORED = {
    "players": Keyed(("player_id",), keeps="old"),
    "games": _of_game("game_id", keeps="new", parents=()),
    "batting_appearances": _of_game("game_id", "team", "player_id", "player_name", parents=(("games", "game_id"), ("players", "player_id"))),
    "pitching_appearances": _of_game("game_id", "team", "player_id", "player_name", parents=(("games", "game_id"), ("players", "player_id"))),
    "events": _of_game("event_id"),
    "validation_reports": _of_game("game_id", "validation_type", keeps="new", parents=()),
    "events_rejected": _of_game("game_id", "seq"),
    "ambiguous_names": _of_game("game_id", "team", "player_name"),
    "page_errors": _of_game("url", keeps="new", parents=()),
}


def season_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, STORED)


def conformed(df: DataFrame, name: str) -> DataFrame:
    """df with the columns and types of a stored table; what it lacks is null."""
    fields = df.sparkSession.createDataFrame([], TABLES[name]).schema
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


#: Buckets of the tables for analysis, by game.
BUCKETS = 16


def _of_games(name: str) -> bool:
    return TABLES[name].startswith("game_id") or " game_id " in TABLES[name]


def create(spark: SparkSession, database: str = "default", buckets: int = BUCKETS) -> None:
    """The tables, where they are missing; those of games in buckets of games, so that joins of them move no rows."""
    for name, columns in TABLES.items():
        parts = " PARTITIONED BY (season)" if name == "games" else ""
        clusters = f" CLUSTERED BY (game_id) SORTED BY (game_id) INTO {buckets} BUCKETS" if _of_games(name) else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{parts}{clusters}")


def publish(held: Store, database: str = "default", buckets: int = BUCKETS) -> None:
    """A season store's tables as tables of the catalog for analysis, laid out as create() does."""
    for name in TABLES:
        rows = held.read(name)
        if _of_games(name):
            out = rows.repartition(buckets, "game_id").write.bucketBy(buckets, "game_id").sortBy("game_id")
            (out.partitionBy("season") if name == "games" else out).format("parquet").mode("overwrite").saveAsTable(f"{database}.{name}")
        else:
            rows.write.format("parquet").mode("overwrite").saveAsTable(f"{database}.{name}")


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def repeated_keys(df: DataFrame, name: str) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*KEYS[name]).agg(F.count("*").alias("n")).where("n > 1")
