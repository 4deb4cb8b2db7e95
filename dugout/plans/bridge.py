"""The driver's star schema in the library's roles, so that every operator runs on the given tables.

orders are games, lineitem rows box-score lines, suppliers players, events plays. SQL is the same mapping for DuckDB.
Numbers are whole, so both engines agree to the digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import plays as P
from ..session import parts_of, table

DESCRIPTIONS = {"view": "Strikeout Swinging", "signup": "Walk", "purchase": "Single to CF", "error": "Reached on E6", "click": "Wild Pitch; Smith to 2B"}
DOUBLED = "Home Run (Fly Ball to Deep LF)"
#: Players, some 60 bytes each in memory, that go to all tasks.
MOST_SENT = 1 << 20


def parts(spark: SparkSession, sf: str) -> int:
    """Into how many partitions dealt() deals: the box-score lines are the largest table."""
    return parts_of(spark, sf, "lineitem")


def dealt(spark: SparkSession, sf: str, keys: list[str], *tables: DataFrame) -> list[DataFrame]:
    """tables dealt out alike by keys: what groups and joins them by these keys shuffles no more, and a task's share stays
    the same however large they are."""
    return [t.repartition(parts(spark, sf), *keys) for t in tables]


def games(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS game_id", "CAST(o_orderdate AS DATE) AS game_date", "CAST(year(o_orderdate) AS BIGINT) AS season", "concat('T', o_custkey % 30) AS home_team",
        "concat('T', (o_custkey + o_orderkey) % 30) AS away_team", "o_orderkey % 11 AS runs_home_team", "o_custkey % 9 AS runs_away_team", "o_orderpriority AS venue", "o_orderstatus = 'P' AS is_playoff",
    )


def named(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    """lines with their players' names. Players go to the lines, which stay where they are; more than MOST_SENT are hashed
    by task and the lines stream past them, so that no lines of a frequent player are sorted."""
    known = players(spark, sf).select("player_id", "player_name")
    return lines.join(F.broadcast(known) if known.count() <= MOST_SENT else known.hint("shuffle_hash"), "player_id")


def batting(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS game_id", "l_suppkey AS player_id", "CASE WHEN l_linestatus = 'O' THEN 'home' ELSE 'away' END AS team", "CAST(l_linenumber AS BIGINT) AS row_idx",
        "CAST(l_quantity AS BIGINT) AS PA", "greatest(CAST(l_quantity AS BIGINT) - l_linenumber % 3, 0) AS AB", "CAST(l_quantity AS BIGINT) div 3 AS H", "l_partkey % 4 AS R", "l_partkey % 5 AS RBI",
        "CAST(l_linenumber % 3 AS BIGINT) AS BB", "CAST(l_quantity AS BIGINT) % 5 AS SO", "l_partkey % 2 AS HR", "CAST(l_quantity AS BIGINT) div 12 AS doubles", "l_suppkey % 2 AS triples", "l_partkey % 3 AS SB",
        "l_partkey % 7 AS HBP", "l_suppkey % 3 AS SF", "l_returnflag AS flag", "l_partkey AS part",
    )
    return named(spark, sf, lines)


def pitching(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS game_id", "l_partkey % 100 AS player_id", "CASE WHEN l_linestatus = 'O' THEN 'home' ELSE 'away' END AS team", "CAST(l_linenumber AS BIGINT) AS pitching_order", "l_linenumber = 1 AS is_starter",
        "CAST(l_quantity AS BIGINT) AS BF", "CAST(l_quantity AS BIGINT) % 6 AS SO_pitched", "CAST(l_linenumber % 4 AS BIGINT) AS BB_allowed",
    )
    return named(spark, sf, lines)


def players(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr("s_suppkey AS player_id", "s_name AS player_name", "CASE s_nationkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'L' END AS throws", "CAST(s_nationkey AS BIGINT) AS nation_id")


def raw_plays(spark: SparkSession, sf: str) -> DataFrame:
    said = F.try_element_at(F.create_map(*(F.lit(x) for kv in DESCRIPTIONS.items() for x in kv)), F.col("event_type"))
    rows = table(spark, sf, "events").selectExpr(
        "event_id div 50 AS game_id", "event_id AS seq", "(event_id % 50) div 6 + 1 AS inning", "CASE WHEN event_id % 6 < 3 THEN 'top' ELSE 'bottom' END AS inning_half", "user_id % 40 AS batter_id",
        "user_id % 7 AS pitcher_id", "CAST(floor(value) AS BIGINT) % 7 AS pitch_count", "event_type", "value", "ts",
    )
    named = rows.withColumns({"batter_name": F.concat(F.lit("B"), "batter_id"), "pitcher_name": F.concat(F.lit("P"), "pitcher_id")})
    return named.withColumn("description", F.when((F.col("event_type") == "purchase") & (F.col("seq") % 4 == 0), DOUBLED).otherwise(said))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return P.accepted(P.classify(raw_plays(spark, sf)))


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """A batting and a pitching report for each game, the accuracy made of whole numbers."""
    return table(spark, sf, "orders").selectExpr("o_orderkey AS game_id", "inline(array(struct('batting' AS validation_type, o_custkey % 13 AS k), struct('pitching' AS validation_type, o_orderkey % 17 AS k)))").selectExpr(
        "game_id", "validation_type", "CASE WHEN k <> 5 THEN 100.0D - k END AS accuracy_percentage", "k AS discrepancies_count"
    )


SQL = """
WITH games AS (
  SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) AS BIGINT) AS season, 'T' || (o_custkey % 30) AS home_team,
         'T' || ((o_custkey + o_orderkey) % 30) AS away_team, o_orderkey % 11 AS runs_home_team, o_custkey % 9 AS runs_away_team, o_orderpriority AS venue, o_orderstatus = 'P' AS is_playoff
  FROM orders
), players AS (
  SELECT s_suppkey AS player_id, s_name AS player_name, CASE s_nationkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'L' END AS throws, CAST(s_nationkey AS BIGINT) AS nation_id FROM supplier
), batting AS (
  SELECT l_orderkey AS game_id, l_suppkey AS player_id, CASE WHEN l_linestatus = 'O' THEN 'home' ELSE 'away' END AS team, CAST(l_linenumber AS BIGINT) AS row_idx,
         CAST(l_quantity AS BIGINT) AS PA, greatest(CAST(l_quantity AS BIGINT) - l_linenumber % 3, 0) AS AB, CAST(l_quantity AS BIGINT) // 3 AS H, l_partkey % 4 AS R, l_partkey % 5 AS RBI,
         CAST(l_linenumber % 3 AS BIGINT) AS BB, CAST(l_quantity AS BIGINT) % 5 AS SO, l_partkey % 2 AS HR, CAST(l_quantity AS BIGINT) // 12 AS doubles, l_suppkey % 2 AS triples, l_partkey % 3 AS SB,
         l_partkey % 7 AS HBP, l_suppkey % 3 AS SF, l_returnflag AS flag, l_partkey AS part, player_name
  FROM lineitem JOIN players ON l_suppkey = player_id
), pitching AS (
  SELECT l_orderkey AS game_id, l_partkey % 100 AS player_id, CASE WHEN l_linestatus = 'O' THEN 'home' ELSE 'away' END AS team, CAST(l_linenumber AS BIGINT) AS pitching_order, l_linenumber = 1 AS is_starter,
         CAST(l_quantity AS BIGINT) AS BF, CAST(l_quantity AS BIGINT) % 6 AS SO_pitched, CAST(l_linenumber % 4 AS BIGINT) AS BB_allowed, player_name
  FROM lineitem JOIN players ON l_partkey % 100 = player_id
), plays AS (
  SELECT event_id // 50 AS game_id, event_id AS seq, (event_id % 50) // 6 + 1 AS inning, CASE WHEN event_id % 6 < 3 THEN 'top' ELSE 'bottom' END AS inning_half, user_id % 40 AS batter_id,
         user_id % 7 AS pitcher_id, CAST(floor(value) AS BIGINT) % 7 AS pitch_count, event_type, value, ts, 'B' || (user_id % 40) AS batter_name, 'P' || (user_id % 7) AS pitcher_name,
         CASE WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'home_run' WHEN event_type = 'purchase' THEN 'single' END AS hit_type,
         event_type <> 'click' AS is_pa, event_type IN ('view', 'purchase', 'error') AS is_ab, event_type = 'purchase' AS is_hit, event_type = 'signup' AS is_walk, event_type = 'view' AS is_so
  FROM events
), reports AS (
  SELECT game_id, validation_type, CASE WHEN k <> 5 THEN CAST(100 - k AS DOUBLE) END AS accuracy_percentage, k AS discrepancies_count
  FROM (SELECT o_orderkey AS game_id, 'batting' AS validation_type, o_custkey % 13 AS k FROM orders UNION ALL SELECT o_orderkey, 'pitching', o_orderkey % 17 FROM orders)
)
"""
