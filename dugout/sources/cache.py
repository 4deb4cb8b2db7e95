"""The page store: bronze pages by category, with an age limit for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hours that a page of a category stays fresh, and what in an address tells the category.
FRESH_HOURS = {"box_scores": 720, "schedules": 24, "rosters": 168, "play_by_play": 720, "player_pages": 720, "general": 12}
CATEGORY_MARKS = (("box_scores", "/boxes/"), ("schedules", "schedule"), ("rosters", "roster"), ("play_by_play", "play_by_play"), ("play_by_play", "pbp"), ("player_pages", "/players/"))


def category(url: Column | str) -> Column:
    low = F.lower(F.col(url) if isinstance(url, str) else url)
    out = F
    for name, mark in CATEGORY_MARKS:
        out = out.when(low.contains(mark), name)
    return out.otherwise("general")


def is_fresh(fetched_at: Column, kind: Column, now: Column | None = None) -> Column:
    hours = F.try_element_at(F.create_map(*(F.lit(x) for kv in FRESH_HOURS.items() for x in kv)), kind)
    age = F.unix_timestamp(now if now is not None else F.current_timestamp()) - F.unix_timestamp(fetched_at)
    return age < hours * 3600


def fresh(pages: DataFrame, now: Column | None = None) -> DataFrame:
    """The latest page of each address, if it is fresh."""
    latest = pages.groupBy("url").agg(F.max_by(F.struct(*(c for c in pages.columns if c != "url")), "fetched_at").alias("p")).select("url", "p.*")
    return latest.where(is_fresh(F.col("fetched_at"), F.col("category"), now))


def to_fetch(wanted: DataFrame, pages: DataFrame, now: Column | None = None) -> DataFrame:
    """wanted(url) that no fresh page answers."""
    return wanted.join(fresh(pages, now).select("url"), "url", "left_anti")


def purge(pages: DataFrame, now: Column | None = None) -> DataFrame:
    return pages.where(is_fresh(F.col("fetched_at"), F.col("category"), now))


def clear(pages: DataFrame, kind: str | None = None) -> DataFrame:
    return pages.where(F.lit(False)) if kind is None else pages.where(F.col("category") != kind)


def stats(pages: DataFrame) -> DataFrame:
    """(category, pages, bytes)."""
    return pages.groupBy("category").agg(F.count("*").alias("pages"), F.sum(F.octet_length("html")).cast("long").alias("bytes"))


def hit_rate(requests: DataFrame) -> DataFrame:
    """requests(hit): hits, misses and their rate."""
    return requests.agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses"), (F.count_if("hit") / F.count("*")).alias("hit_rate"))


def append(spark: SparkSession, pages: DataFrame, path: str) -> None:
    pages.withColumn("category", category("url")).write.mode("append").partitionBy("category").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
