"""Stored tables, logs and the page store."""

import datetime

from pyspark.sql import functions as F

from dugout import schemas
from dugout.operators import reconcile as R
from dugout.operators import store as K
from dugout.plans import reports
from dugout.sources import cache, tables


def test_create_makes_every_table_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS dugout_test")
    for _ in range(2):
        schemas.create(spark, "dugout_test")
    made = {t.name for t in spark.catalog.listTables("dugout_test") if not t.isTemporary}
    assert made == set(schemas.TABLES)
    assert spark.table("dugout_test.games").schema["season"].dataType.simpleString() == "int"
    spark.sql("DROP DATABASE dugout_test CASCADE")


def test_published_tables_join_games_without_moving_rows(spark, tmp_path):
    """Buckets of games: joins and groupings by game have no exchange, and what is published equals the store."""
    from dugout.plans import demo, season

    season.store(demo.pages(spark, 3), str(tmp_path / "store"))
    held, old = schemas.season_store(spark, str(tmp_path / "store")), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.sql("CREATE DATABASE IF NOT EXISTS dugout_published")
    schemas.create(spark, "dugout_published")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        schemas.publish(held, "dugout_published", 4)
        read = lambda n: spark.table(f"dugout_published.{n}")
        lines = read("events").join(read("games").select("game_id", "venue", "season"), "game_id").groupBy("game_id").agg(F.count("*").alias("n")).join(read("batting_appearances"), "game_id")
        assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
        assert all(read(n).count() == held.read(n).count() for n in schemas.TABLES) and lines.count() == held.read("batting_appearances").count()
        assert spark.table("dugout_published.games").where("season = 2024")._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [isnotnull(season") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP DATABASE dugout_published CASCADE")


def test_new_players_are_enriched(spark):
    stored = spark.createDataFrame([("a", "Ann")], "player_id string, full_name string")
    seen = spark.createDataFrame([("a", "Ann"), ("b", "Bo"), ("c", "Cy")], "player_id string, player_name string")
    bios = spark.createDataFrame([("b", "Robert Bo", "R")], "player_id string, full_name string, bats string")
    got = {r["player_id"]: (r["full_name"], r["bats"], r["source"]) for r in K.enrich_new_players(stored, seen, bios).collect()}
    assert got == {"b": ("Robert Bo", "R", "bio"), "c": ("Cy", None, "box_score")}


def test_page_store(spark, tmp_path):
    now = datetime.datetime(2024, 6, 30)
    rows = [("https://x.test/boxes/a", 29), ("https://x.test/boxes/b", 31), ("https://x.test/pbp", 29), ("https://x.test/pbp2", 31), ("https://x.test/roster", 6), ("https://x.test/roster2", 8), ("https://x.test/schedule", 2)]
    pages = spark.createDataFrame([(u, "<p>", now - datetime.timedelta(days=d)) for u, d in rows], "url string, html string, fetched_at timestamp")
    path = str(tmp_path / "pages")
    cache.append(spark, pages, path)
    held = cache.read(spark, path)
    left = {r["url"].rsplit("/", 1)[1] for r in cache.purge(held, F.lit(now)).collect()}
    assert left == {"a", "pbp", "roster"}
    assert cache.clear(held).count() == 0 and cache.clear(held, "rosters").count() == 5
    assert cache.hit_rate(spark.createDataFrame([(True,), (False,), (True,), (True,)], "hit boolean")).first()["hit_rate"] == 0.75


def test_logs_and_grades(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.5), ("b", None)], "game_id string, accuracy double")
    for path, write in ((str(tmp_path / "log"), tables.append_log), (str(tmp_path / "batch"), reports.write_batch)):
        write(rows, path)
        write(rows, path)
        assert tables.read_log(spark, path, "game_id string, accuracy double").count() == 4
    got = [r[0] for r in spark.createDataFrame([(100.0,), (99.5,), (98.0,)], "v double").select(R.grade(F.col("v"))).collect()]
    assert got == ["perfect", "good", "needs_work"]
