"""A made-up game, from its page to the gate."""

import pytest
from pyspark.sql import functions as F

from dugout.functions import text as T
from dugout.functions import plays as P
from dugout.operators import events as E
from dugout.operators import lineup as L
from dugout.operators import names as N
from dugout.operators import reconcile as R
from dugout.operators import stats as S
from dugout.plans import season
from dugout.sources import box_pages as B
from dugout.sources import cache, schedule


def row(*cells, head=False):
    tag = "th" if head else "td"
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def player(name, ref, code="", pad=False):
    return f"{'&nbsp;&nbsp;' if pad else ''}<a href='/players/{ref[0]}/{ref}.shtml'>{name}</a> {code}"


BAT = ("Batting", "AB", "R", "H", "RBI", "BB", "SO", "PA", "Details")
PIT = ("Pitching", "IP", "H", "R", "ER", "BB", "SO", "HR", "BF", "Pit")
PBP = ("Inn", "Batter", "Pitcher", "Pit(cnt)", "Play Description")


def page(hits=1):
    away = f"<table id='AAAbatting'>{row(*BAT, head=True)}{row(player('Ann Lee', 'leean01', 'CF'), 2, 1, hits, 0, 1, 1, 3, 'HR')}{row(*BAT)}{row(player('Bo Diaz', 'diazbo01', 'PH', True), 1, 0, 0, 0, 0, 1, 1, '')}{row(player('Ray Fox', 'foxra01', 'P'), 0, 0, 0, 0, 0, 0, 0, '')}{row('Team Totals', 3, 1, 1, 0, 1, 2, 4, '')}</table>"
    home = f"<!-- <table id='BBBbatting'>{row(*BAT, head=True)}{row(player('Cy Moe', 'moecy01', 'SS'), 1, 0, 0, 0, 0, 0, 1, '')}</table> -->"
    pitch = f"<table id='AAApitching'>{row(*PIT, head=True)}{row(player('Ray Fox', 'foxra01') + ', W (1-0)', '1.0', 0, 0, 0, 0, 0, 0, 1, 3)}</table><table id='BBBpitching'>{row(*PIT, head=True)}{row(player('Sal Kim', 'kimsa01') + ', L (0-1)', '1.1', 1, 1, 1, 1, 2, 1, 4, 15)}</table>"
    plays = [("t1", "Ann Lee", "Sal Kim", "4,(1-2)", "Home Run (Fly Ball to LF)"), ("t1", "Bo Diaz", "Sal Kim", "3,(0-2)", "Strikeout Swinging"), ("Top of the 2nd", "Top of the 2nd", "x", "", "x"), ("t2", "Ann Lee", "Sal Kim", "2,(1-0)", "Wild Pitch; nobody on"), ("t2", "Ann Lee", "Sal Kim", "5,(3-1)", "Walk"), ("t3", "Ann Lee", "Sal Kim", "3,(0-2)", "Strikeout Looking"), ("b1", "Cy Moe", "Ray Fox", "3,(1-1)", "Groundout: SS-1B"), ("b1", "Cy Moe", "Ray Fox", "", "Mound visit")]
    pbp = f"<table id='play_by_play'>{row(*PBP, head=True)}{''.join(row(*p) for p in plays)}</table>"
    box = '<div class="scorebox"><a href="/teams/AAA/2024">A</a><a href="/teams/BBB/2024">B</a><div class="score">1</div><div class="score">0</div><strong>Venue</strong>: Old Park<div class="scorebox_meta"><div>Monday, April 1, 2024</div><div>Start Time: 7:05 p.m. Local</div></div></div><table class="linescore"><tr><th>1</th><th>2</th><th>9</th></tr></table>'
    return f"<html><head><title>A at B, World Series</title></head><body>{box}{away}{home}{pitch}{pbp}</body></html>"


URL = "https://x.test/boxes/BBB/BBB202404010.shtml"


@pytest.fixture(scope="module")
def tables(spark):
    pages = spark.createDataFrame([(URL, page()), ("https://x.test/boxes/CCC/CCC202404020.shtml", page(hits=2)), ("https://x.test/boxes/DDD/DDD202404030.shtml", None), ("https://x.test/empty", "<table id='xbatting'><tr><td")], "url string, html string")
    return season.silver(pages)


def test_relations(tables):
    batting = {(r["team"], r["player_name"]): r for r in tables["batting"].where("game_id = 'BBB202404010'").collect()}
    assert set(batting) == {("away", "Ann Lee"), ("away", "Bo Diaz"), ("home", "Cy Moe")}
    lee, diaz = batting["away", "Ann Lee"], batting["away", "Bo Diaz"]
    assert (lee["batting_order"], lee["is_starter"], lee["HR"], lee["player_id"]) == (1, True, 1, "leean01")
    assert (diaz["batting_order"], diaz["is_substitute"], diaz["is_indented"]) == (1, True, True)
    pitching = {r["player_name"]: r for r in tables["pitching"].where("game_id = 'BBB202404010'").collect()}
    assert pitching["Sal Kim"]["decisions"] == ["L"] and pitching["Sal Kim"]["pitching_order"] == 1 and str(pitching["Sal Kim"]["IP"]) == "1.1"
    game = tables["games"].where("game_id = 'BBB202404010'").first()
    assert (game["away_team"], game["home_team"], game["winner"], game["venue"], str(game["game_date"]), game["is_playoff"], game["innings_played"]) == ("AAA", "BBB", "AAA", "Old Park", "2024-04-01", True, 9)


def test_events(tables):
    events = tables["events"].where("game_id = 'BBB202404010'").orderBy("event_order").collect()
    assert [e["rule"] for e in events] == ["home_run", "strikeout", "out", "running", "walk", "strikeout"]
    assert [e["pitch_count"] for e in events] == [4, 3, 3, 0, 5, 3]
    assert events[0]["batter_id"] == "leean01" and events[0]["pitcher_id"] == "kimsa01" and len({e["event_id"] for e in events}) == 6
    assert tables["events_rejected"].where("game_id = 'BBB202404010'").count() == 1


def test_reconciliation_and_gate(tables):
    reports = {(r["game_id"], r["validation_type"]): r for r in season.reports(tables).collect()}
    assert reports["BBB202404010", "batting"]["accuracy_percentage"] == 100 and reports["BBB202404010", "pitching"]["status"] == "success"
    assert reports["CCC202404020", "batting"]["discrepancies_count"] == 1
    assert [r["game_id"] for r in season.gate(season.reports(tables), 99).collect()] == ["BBB202404010"]


def test_namesakes_and_broken_pages(spark, tmp_path):
    """Two players of one name on two sides are compared apart and have their ids; two in one team have none. Failed pages say why."""
    twin = page().replace("Cy Moe", "Ann Lee")
    same = page().replace("Bo Diaz", "Ann Lee").replace("h1>", "h2>")
    url = "https://x.test/boxes/{0}/{0}202404010.shtml"
    no_plays = "<table id='xbatting'><tr><th>Batting</th><th>AB</th></tr><tr><td>A</td><td>1</td></tr></table>"
    pages = spark.createDataFrame([(url.format("BBB"), twin), (url.format("CCC"), same), (url.format("DDD"), None), (url.format("EEE"), "<p>none"), (url.format("FFF"), no_plays)], "url string, html string")
    kept = season.Kept()
    tables = season.process(pages, least=100, kept=kept)
    reports = {(r["game_id"][:3], r["validation_type"]): r["accuracy_percentage"] for r in tables["validation_reports"].collect()}
    assert reports["BBB", "batting"] == 100 and reports["BBB", "pitching"] == 100 and reports["CCC", "batting"] == 100
    ids = {(r["inning_half"], r["batter_name"]): r["batter_id"] for r in tables["events"].where("game_id like 'BBB%' and batter_name = 'Ann Lee'").collect()}
    assert ids == {("top", "Ann Lee"): "leean01", ("bottom", "Ann Lee"): "moecy01"}
    assert [tuple(r) for r in tables["ambiguous_names"].collect()] == [("CCC202404010", "away", "Ann Lee")]
    assert tables["events"].where("game_id like 'CCC%' and batter_name = 'Ann Lee' and batter_id is not null").count() == 0
    assert {r["game_id"][:3]: r["error"] for r in tables["page_errors"].collect()} == {"DDD": "missing page", "EEE": "no table found", "FFF": "no pitching table found, no plays table found"}
    states = {r["game_id"][:3]: r["processing_status"] for r in season.outcomes(pages, tables, spark.createDataFrame([("BBB202404010",)], "game_id string")).collect()}
    assert states == {"BBB": "skipped", "CCC": "success", "DDD": "error", "EEE": "error", "FFF": "error"}
    assert kept.tables
    kept.release()
    counts = {r["table_name"]: r["n"] for r in season.store(pages, str(tmp_path / "store"), least=100).collect()}
    assert counts["games"] == 2 and counts["page_errors"] == 3 and counts["batting_appearances"] == 6


def test_rows_are_not_shuffled(spark):
    pages = spark.createDataFrame([(URL, page())], "url string, html string")
    assert "Exchange" not in B.batting(B.rows(pages))._jdf.queryExecution().executedPlan().toString()


def test_half_innings(spark):
    raw = spark.createDataFrame([(x,) for x in ("t1", "b12", "Top of the 1st", "", None, "t", "T1")], "inn string")
    assert [r["inn"] for r in E.half_innings(raw).collect()] == ["t1", "b12"]


def test_process_skips_stored_games(spark):
    pages = spark.createDataFrame([(URL, page())], "url string, html string")
    out = season.process(pages, spark.createDataFrame([("BBB202404010",)], "game_id string"))
    assert out["batting"].count() == 0


def test_bases_and_outs(spark):
    plays = [(1, "A", "walk", 0, True, 0), (2, "B", "walk", 0, True, 0), (3, "C", "hit_by_pitch", 0, False, 0), (4, "D", "walk", 0, True, 0), (5, "E", "double", 2, False, 0), (6, "F", "out", 0, False, 1), (7, "G", "double_play", 0, False, 2), (8, "H", "home_run", 4, False, 0)]
    events = spark.createDataFrame([("g", *p) for p in plays], "game_id string, seq long, batter_name string, rule string, bases_reached int, is_walk boolean, outs_recorded int")
    got = {r["seq"]: r for r in E.base_machine(events).collect()}
    assert [got[i]["runs"] for i in range(1, 9)] == [0, 0, 0, 1, 2, 0, 0, 1]
    assert got[4]["bases"] == ["D", "C", "B"] and got[5]["bases"] == [None, "E", "D"] and got[7]["bases"] == [None] * 3
    outs = {r["seq"]: r for r in E.outs_machine(events).collect()}
    assert (outs[7]["outs_before"], outs[7]["outs_after"], outs[8]["half_no"]) == (1, 3, 2)


def test_strikeouts_are_outs(spark):
    said = ["Walk", "Strikeout Swinging", "Strikeout Looking", "Strikeout Swinging Wild Pitch", "Strikeout Swinging", "Single to CF"]
    plays = spark.createDataFrame([("g", i, f"B{i}", "P", 3, d) for i, d in enumerate(said)], "game_id string, seq long, batter_name string, pitcher_name string, pitch_count int, description string")
    events = P.classify(plays)
    outs = {r["seq"]: tuple(r)[2:] for r in E.outs_machine(events).collect()}
    assert outs == {0: (1, 0, 0), 1: (1, 0, 1), 2: (1, 1, 2), 3: (1, 2, 2), 4: (1, 2, 3), 5: (2, 0, 0)}
    assert {r["seq"]: r["bases"] for r in E.base_machine(events).collect()}[5] == ["B5", None, None]
    assert R.pitcher_lines(events).first()["outs"] == 3 and R.pitcher_lines(events.drop("rule")).first()["outs"] == 3


def test_running_moves_the_bases(spark):
    said = [("Ann Lee", "Reached on E6"), ("Bo Diaz", "Lee Steals 2B"), ("Bo Diaz", "Walk"), ("Cy Moe", "Bo Diaz Caught Stealing 2B (C-SS)"), ("Cy Moe", "Single to CF; Ann Lee Scores"), ("Di Fox", "Flyball: CF"), ("Di Fox", "Groundout: SS-1B")]
    plays = spark.createDataFrame([("g", i, b, "P", d) for i, (b, d) in enumerate(said)], "game_id string, seq long, batter_name string, pitcher_name string, description string")
    events = P.classify(plays)
    got = [tuple(r)[2:] for r in E.base_machine(events).orderBy("seq").collect()]
    ann, moe = "Ann Lee", "Cy Moe"
    assert got == [(0, [ann, None, None]), (0, [None, ann, None]), (0, ["Bo Diaz", ann, None]), (0, [None, ann, None]), (1, [moe, None, None]), (0, [moe, None, None]), (0, [None] * 3)]
    assert [r["outs_after"] for r in E.outs_machine(events).orderBy("seq").collect()] == [0, 0, 0, 1, 1, 2, 3]


def test_context_form_and_reports(spark):
    from dugout.plans import reports

    results = spark.createDataFrame([("a", 100.0), ("b", 90.0)], "game_id string, accuracy double")
    diffs = spark.createDataFrame([("a", "A", "H", 2.0), ("a", "A", "SO", -1.0), ("b", "B", "H", 1.0)], "game_id string, player_name string, stat string, diff double")
    said = [r["line"] for r in reports.text_report(results, diffs).orderBy("line_no").collect()]
    assert said[:3] == ["Games: 2", "Mean accuracy: 95.00", "Lowest accuracy: 90.00"] and said[-2:] == ["  H differs by 3 over 2 players", "  SO differs by 1 over 1 players"] and len(said) == 7
    spread = {r["kind"]: (r["players"], [x["player_name"] for x in r["sample"]]) for r in R.discrepancy_spread(diffs, ["game_id", "player_name"]).collect()}
    assert spread == {"single": (1, ["B"]), "multiple": (1, ["A"])}


def test_runners_and_totals(spark):
    plays = spark.createDataFrame([("g", 1, "Ann Lee Steals 2nd; Bo Diaz Scores"), ("g", 2, "Cy Moe Caught Stealing home")], "game_id string, seq long, description string")
    got = {(r["kind"], r["runner"], r["to_base"]) for r in E.runner_events(plays).collect()}
    assert got == {("steal", "Ann Lee", "2nd"), ("run", "Bo Diaz", None), ("caught", "Cy Moe", "home")}


def test_name_resolution(spark):
    known = spark.createDataFrame([("g", "Ann Lee", "l1"), ("g", "Abe Lee", "l2"), ("g", "Ken Roy Jr.", "r1")], "game_id string, player_name string, player_id string")
    asked = spark.createDataFrame([("g", n) for n in ("Ann Lee", "ANN LEE", "K. Roy", "Roy", "Lee", "A. Lee", "Ken Roy", "Zed")], "game_id string, who string")
    got = {r["who"]: r["id"] for r in N.resolve(asked, known, "who", "id").collect()}
    assert got == {"Ann Lee": "l1", "ANN LEE": "l1", "K. Roy": "r1", "Roy": "r1", "Lee": None, "A. Lee": None, "Ken Roy": "r1", "Zed": None}


def test_cache_and_schedule(spark):
    pages = spark.createDataFrame([("https://x.test/schedule", "2024-01-02 00:00:00", "schedules", "a"), ("https://x.test/schedule", "2024-01-01 00:00:00", "schedules", "b"), ("https://x.test/z", "2024-01-01 00:00:00", "general", "c")], "url string, t string, category string, html string").withColumn("fetched_at", F.to_timestamp("t"))
    now = F.to_timestamp(F.lit("2024-01-02 12:00:00"))
    assert [r["html"] for r in cache.fresh(pages, now).collect()] == ["a"]
    assert {r["category"]: r["pages"] for r in cache.stats(pages).collect()} == {"schedules": 2, "general": 1}
    assert schedule.season_days(spark, 2024).count() == 275 and schedule.last_days(spark, 3, "2024-05-05").count() == 3
    index = spark.createDataFrame([("u", '<a href="/boxes/NYA/NYA202404010.shtml">x</a><a href="/boxes/NYA/NYA202404010.shtml">')], "url string, html string")
    assert schedule.links(index).count() == 1


def test_accuracy_of_an_injected_error(spark):
    official = spark.createDataFrame([("g", "A", 4, 2), ("g", "B", 3, 1)], "game_id string, player_name string, PA int, H int")
    parsed = spark.createDataFrame([("g", "A", 4, 1), ("g", "C", 3, 1)], "game_id string, player_name string, PA int, H int")
    diffs = R.differences(official, parsed, ["game_id", "player_name"], ("PA", "H"))
    assert R.accuracy(diffs, ["game_id"]).first()["accuracy"] == pytest.approx((6 - 1) / 6 * 100)
    assert R.difference_texts(diffs, ["player_name"]).first()["texts"] == ["H: 2 vs 1 (diff: -1)"]
    assert {r["found"] for r in R.provenance(official, parsed, ["game_id", "player_name"]).collect()} == {"both", "left_only", "right_only"}


def test_line_ups_and_rates(spark):
    rows = spark.createDataFrame([("g", "home", i, [c], False, pa, pa) for i, (c, pa) in enumerate([("CF", 4), ("PH", 1), ("PR", 0), ("SS", 4)])], "game_id string, team string, row_idx int, positions array<string>, is_indented boolean, PA int, AB int")
    assert [r["batting_order"] for r in L.batting_order(rows).orderBy("row_idx").collect()] == [1, 1, None, 2]
    assert [r["is_starter"] for r in L.first_nine(rows).orderBy("row_idx").collect()] == [True, True, False, True]
    out = spark.range(1).select(S.rate(F.lit(201), F.lit(400)).alias("a"), S.rate(F.lit(1), F.lit(0)).alias("b"), S.innings_to_outs(F.lit(5.2)).alias("c")).first()
    assert tuple(out) == (0.503, None, 17)


def test_empty_pages(spark):
    out = season.silver(spark.createDataFrame([], "url string, html string"))
    assert all(df.count() == 0 for df in out.values())
    assert B.cells(spark.createDataFrame([("u", None)], "url string, html string")).count() == 0


def test_made_season_reconciles(spark):
    from dugout.plans import demo

    pages = demo.pages(spark, 40).cache()
    out = season.process(pages, least=100)
    assert pages.select(F.countDistinct(T.game_id("url"))).first()[0] == 40
    assert out["validation_reports"].where("accuracy_percentage <> 100").count() == 0
    assert out["batting"].count() == 40 * 18 and out["pitching"].count() == 80 and out["events_rejected"].count() == 0
    assert out["events"].where("batter_id is null or pitcher_id is null").count() == 0
