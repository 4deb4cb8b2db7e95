"""Stored tables from elsewhere: a database over JDBC, logs in CSV, settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The names that the settings have in the environment.
SETTINGS = {"host": "DB_HOST", "port": "DB_PORT", "database": "DB_NAME", "user": "DB_USER", "password": "DB_PASSWORD"}


def settings(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """The database's settings; an error names all that are missing."""
    missing = [name for name in SETTINGS.values() if not env.get(name)]
    if missing:
        raise KeyError(f"not set: {', '.join(missing)}")
    return {k: env[name] for k, name in SETTINGS.items()}


def jdbc(spark: SparkSession, table: str, known: Mapping[str, str], split_by: str | None = None, low: int = 0, high: int = 0, parts: int = 8) -> DataFrame:
    """A database's table, read in parts by a numeric column if one is named; filters go down to the database."""
    url, options = f"jdbc:postgresql://{known['host']}:{known['port']}/{known['database']}", {"user": known["user"], "password": known["password"]}
    return _scan(spark, url, table, options, (split_by, low, high, parts) if split_by else None)


def _scan(spark: SparkSession, url: str, table: str, options: Mapping[str, str], split: tuple[str, object, object, int] | None) -> DataFrame:
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        reader = reader.options(partitionColumn=split[0], lowerBound=str(split[1]), upperBound=str(split[2]), numPartitions=str(split[3]))
    return reader.load()


def scan(spark: SparkSession, url: str, table: str, split_by: str, parts: int = 8, **options: str) -> DataFrame:
    """A table of any database with a driver, read in parts by a number, date or time, whose bounds the database is asked for.

    An empty table, or one without a value in that column, is read in one part. options: those of the reader, as driver or user.
    """
    whole = _scan(spark, url, table, options, None)
    column = next(c for c in whole.columns if c.lower() == split_by.lower())
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    bounds = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({quoted}) AS low_bound, MAX({quoted}) AS high_bound FROM {table}", **options).load().first()
    low, high = bounds[0], bounds[1]
    return whole if low is None or low == high else _scan(spark, url, table, options, (column, low, high, parts))


def reachable(spark: SparkSession, url: str, ask: str = "SELECT 1 AS one", **options: str) -> str | None:
    """None if the database answers, else what it says."""
    try:
        spark.read.format("jdbc").options(url=url, query=ask, **options).load().first()
    except Exception as error:  # noqa: BLE001  whatever the driver throws
        return str(error).splitlines()[0]
    return None


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", True).csv(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def known_games(asked: DataFrame, stored: DataFrame) -> DataFrame:
    """asked(game_id) with is_stored, for a whole batch at once."""
    held = stored.select("game_id").distinct().withColumn("is_stored", F.lit(True))
    return asked.join(held, "game_id", "left").withColumn("is_stored", F.coalesce("is_stored", F.lit(False)))
