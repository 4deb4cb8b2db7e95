"""Every query with SQL gives the SQL's rows on the smallest tables."""

import datetime
import decimal
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from dugout import queries as Q
from dugout import schemas, session
from dugout.operators import stats
from dugout.plans import bridge

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return int(v) if v == int(v) else round(float(v), 6)
    return str(v) if isinstance(v, (datetime.date, datetime.datetime)) else v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([cell(r[i]) for i in order]) for r in values)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    got = Q.QUERIES[name](spark, SF)
    want = duck.execute(Q.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_without_sql(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


def test_box_pitching_of_pages_that_share_a_game_id(spark, tmp_path):
    """Six digits: two pages, one id of five digits; each page has its own first pitcher."""
    spark.createDataFrame([(100_001, "<p>a</p>"), (100_002, None)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got, want = Q.QUERIES["box_pitching"](spark, str(tmp_path)), duck.execute(Q.ORACLE_SQL["box_pitching"])
    names = [d[0] for d in want.description]
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


_DEALT = ("name_diff_both_ways", "difference_texts", "drill_down", "batch_report", "discrepancy_unpivot", "reconcile_accuracy", "discrepancy_spread", "wide_appearances", "two_way_by_pa", "form_before", "recent_form_buckets", "resolved_sides", "alias_resolution")


@pytest.mark.parametrize("name", _DEALT)
def test_partitions_grow_with_the_tables(spark, monkeypatch, name):
    """What is dealt out by game or player goes to partitions in proportion to the stored lines, whatever the session's number."""
    monkeypatch.setattr(session, "PART_BYTES", 2_000)
    n = session.parts_of(spark, SF, "lineitem")
    assert n > 20
    plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and re.search(r"\((?:game_id|player_id)#", line)]
    assert exchanges and all(f", {n}), REPARTITION_BY_NUM" in line for line in exchanges)


def test_partitions_follow_rows_however_packed(spark, monkeypatch, tmp_path):
    """A file that packs its rows well gets no fewer partitions."""
    monkeypatch.setattr(session, "PART_ROWS", 1_000, raising=False)
    spark.range(50_000).selectExpr("1 AS l_orderkey").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert session.parts_of(spark, str(tmp_path), "lineitem") == 50


def shuffles(df):
    """The shuffles by hash that a run of df wrote, reused ones once."""
    df.collect()
    run = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in run.splitlines() if re.match(r"[\s:+*-]*Exchange hashpartitioning\(", line)]


def test_names_of_a_side_meet_where_its_lines_are(spark):
    """Lines are dealt out once; neither names nor keys of names are shuffled."""
    got = shuffles(Q.QUERIES["resolved_sides"](spark, SF))
    assert len(got) == 1 and re.search(r"\(game_id#\d+L, \d+\), REPARTITION_BY_NUM", got[0])


def test_rows_of_the_context_move_by_game_and_by_player_alone(spark, monkeypatch):
    """However large Spark takes the lines to be, no kind of line shuffles the rows again."""
    monkeypatch.setattr(session, "PART_BYTES", 2_000)
    n = session.parts_of(spark, SF, "lineitem")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = shuffles(Q.QUERIES["game_context"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    dealt = [re.sub(r"#\d+L", "", re.search(r"hashpartitioning\((.*?)\)", x)[1]) for x in got if "REPARTITION_BY_NUM" in x]
    assert sorted(dealt) == [f"game_id, {n}"] * 3 + [f"player_id, {n}"]
    assert not [x for x in got if re.search(r"\(player_id#\d+L, [a-z]", x)]


@pytest.mark.parametrize("most", [stats.MOST_SENT, 0])
def test_context_holds_the_lines_of_their_operators(spark, monkeypatch, most):
    """All fields, with players on both sides of a game, games without a venue or season, and lines too many to send."""
    monkeypatch.setattr(stats, "MOST_SENT", most)
    batting, pitching, events, players = (f(spark, SF) for f in (bridge.batting, bridge.pitching, bridge.events, bridge.players))
    games = bridge.games(spark, SF).withColumns({"venue": F.expr("if(game_id % 5 = 0, null, venue)"), "season": F.expr("if(game_id % 7 = 0, null, season)")})
    got = stats.game_context(batting, pitching, events, games, players, 3)
    packs = {
        "form": (stats.form_before(batting, games), ["player_id", "game_id"]),
        "season_line": (stats.season_lines(batting, games), ["player_id", "season"]),
        "matchup": (stats.matchup_lines(events).withColumnRenamed("batter_id", "player_id"), ["player_id", "pitcher_id"]),
        "handedness": (stats.handedness_lines(events, games, players).withColumnRenamed("batter_id", "player_id"), ["player_id", "season", "against"]),
        "at_venue": (stats.venue_lines(batting, games), ["player_id", "venue"]),
        "at_location": (stats.home_away_lines(batting, games), ["player_id", "season", "location"]),
        "starter": (stats.opposing_starters(batting, pitching, players), ["game_id", "player_id", "team"]),
    }
    both = got.withColumn("starter", F.struct("pitcher_id", "throws"))
    for name, (lines, keys) in packs.items():
        assert set(lines.columns) - set(keys) == set(both.schema[name].dataType.names)
        both = both.join(lines.select(*keys, F.struct(*both.schema[name].dataType.names).alias(f"want_{name}")), keys, "left")
    said = lambda c: F.coalesce(F.to_json(c), F.lit("{}"))
    row = both.agg(F.count("*").alias("n"), F.count_distinct("game_id", "player_id", "team").alias("rows"), *(F.count_if(said(c) != said(f"want_{c}")).alias(c) for c in packs), *(F.count_if(said(c) != "{}").alias(f"held_{c}") for c in packs)).first()
    assert row["n"] == row["rows"] == batting.join(games, "game_id").select("game_id", "player_id", "team").distinct().count()
    assert [c for c in packs if row[c]] == [] and all(row[f"held_{c}"] for c in packs)


_DIFFERENCES = ("drill_down", "batch_report", "discrepancy_unpivot", "reconcile_accuracy")


@pytest.mark.parametrize("name", _DIFFERENCES)
def test_lines_are_not_dealt_by_player_alone(spark, name):
    """Where Spark would broadcast nothing, a frequent player's lines still don't meet in one task."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "hashpartitioning(game_id#" in plan and not re.search(r"hashpartitioning\(player_id#\d+L?, \d", plan)


@pytest.mark.parametrize("name", _DIFFERENCES)
def test_players_too_many_to_send(spark, duck, monkeypatch, name):
    """They are hashed, the lines aren't sorted for them, and the rows are the same."""
    monkeypatch.setattr(bridge, "MOST_SENT", 0, raising=False)
    got, want = Q.QUERIES[name](spark, SF), duck.execute(Q.ORACLE_SQL[name])
    joins = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if re.search(r"Join \[player_id#\d+L?\]", line)]
    assert joins and all("ShuffledHashJoin" in line for line in joins)
    names = [d[0] for d in want.description]
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_works_without_llm(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/dugout", tmp_path / "dugout", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'season_line' in q and not [x for x in q if x.startswith('op') and x[2].isdigit()] and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_schemas(spark):
    assert all(schemas.empty(spark, n).count() == 0 for n in schemas.TABLES)
    assert schemas.repeated_keys(spark.createDataFrame([("a",), ("a",), ("b",)], "player_id string"), "players").count() == 1
