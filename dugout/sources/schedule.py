"""Which games to read: days of a season, links of index and schedule pages, first and last of a team."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The first and last month and day of a season.
SEASON = ("03-01", "11-30")


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))


def season_days(spark: SparkSession, year: int) -> DataFrame:
    return days(spark, f"{year}-{SEASON[0]}", f"{year}-{SEASON[1]}")


def last_days(spark: SparkSession, n: int, end: str | None = None) -> DataFrame:
    """The n days up to end, by default yesterday; none in the future."""
    last = F.lit(end).cast("date") if end else F.date_sub(F.current_date(), 1)
    return spark.range(1).select(F.explode(F.sequence(F.date_sub(last, n - 1), last)).alias("day")).where(F.col("day") < F.current_date())


def links(pages: DataFrame, pattern: str = r"/boxes/[A-Z]{3}/[A-Z]{3}\d{8,9}\.shtml") -> DataFrame:
    """(url, place, link): box-score links of index pages in page order, each once."""
    found = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(rf'href="[^"]*?({pattern})"'), F.lit(1))).alias("place", "link"))
    return found.groupBy("url", "link").agg(F.min("place").alias("place"))


def index_day(url: Column | str) -> Column:
    """The day that the address of an index page asks for."""
    url = F.col(url) if isinstance(url, str) else url
    year, month, day = (F.regexp_extract(url, rf"[?&]{part}=(\d+)", 1).try_cast("int") for part in ("year", "month", "day"))
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


def store_index(pages: DataFrame, path: str) -> None:
    """Index pages(url, html) by day, so that a span of days reads its own files alone. Pages of no day are left out."""
    pages.withColumn("day", index_day("url")).where("day is not null").repartition("day").write.mode("append").partitionBy("day").parquet(path)


def discover(spark: SparkSession, path: str, first: str, last: str, site: str = "", today: Column | None = None) -> DataFrame:
    """(day, place, url): games of the stored index pages of first to last, before today, each address once where it came first.

    A link counts on the page of its own day. place is its number on that page, so (day, place) is the order of discovery.
    """
    now = today if today is not None else F.current_date()
    pages = spark.read.parquet(path).where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & (F.col("day") < now))
    found = pages.select("day", F.posexplode(F.regexp_extract_all("html", F.lit(r"""href=["']?[^"'\s>]*?(/boxes/[A-Z]{3}/[A-Z]{3}\d{9}\.shtml)"""), F.lit(1))).alias("place", "link"))
    own = found.where(F.regexp_extract("link", r"/[A-Z]{3}(\d{8})\d\.", 1) == F.date_format("day", "yyyyMMdd"))
    return own.groupBy("day", "link").agg(F.min("place").alias("place")).select("day", "place", (absolute(F.col("link"), site) if site else F.col("link")).alias("url"))


def season_games(spark: SparkSession, path: str, year: int, site: str = "", today: Column | None = None) -> DataFrame:
    """discover() over a season's days."""
    return discover(spark, path, f"{year}-{SEASON[0]}", f"{year}-{SEASON[1]}", site, today)


def played(found: DataFrame, today: Column | None = None) -> DataFrame:
    """Links whose date in the id is before today."""
    day = F.try_to_timestamp(F.regexp_extract("link", r"[A-Z]{3}(\d{8})", 1), F.lit("yyyyMMdd")).cast("date")
    return found.where(day < (today if today is not None else F.current_date()))


def edge_games(games: DataFrame, n: int, last: bool = False, team: str = "team") -> DataFrame:
    """The first or last n games of each team by date and id."""
    order = [F.desc("game_date"), F.desc("game_id")] if last else ["game_date", "game_id"]
    return games.withColumn("_n", F.row_number().over(W.partitionBy(team).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def absolute(link: Column, site: str) -> Column:
    """site and link with one slash between."""
    return F.concat(F.lit(site.rstrip("/") + "/"), F.regexp_replace(link, "^/+", ""))
