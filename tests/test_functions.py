import unicodedata

import pytest
from pyspark.sql import functions as F

from dugout.functions import metadata as M
from dugout.functions import plays as P
from dugout.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.game_id, "https://x.test/boxes/NYA/NYA202404010.shtml", "NYA202404010"),
        (T.game_id, "https://x.test/teams/NYA", "unknown"),
        (T.game_id, None, "unknown"),
        (T.first_integer, "t12", 12),
        (T.first_integer, None, 0),
        (T.inning_half, "Top 1", "top"),
        (T.inning_half, "b9", "bottom"),
        (T.inning_half, "x", ""),
        (T.leading_integer, "5,(3-2)", 5),
        (T.leading_integer, "x5", 0),
        (T.safe_int, "3.9", 3),
        (T.safe_int, "abc", 0),
        (T.decisions, "Max Roe, W (1-0), BS (2)", ["W", "BS"]),
        (T.positions, "Ann Lee C-1B", ["C", "1B"]),
        (T.positions, "Ann Lee", []),
        (T.position_name, "ss", "Shortstop"),
        (T.normal_name, "  José  Núñez, W (3-1)", unicodedata.normalize("NFKD", "José Núñez")),
        (T.normal_name, "Ken Roy Jr. CF", "Ken Roy Jr."),
        (T.normal_name, None, ""),
        (T.player_id, "/players/r/roema01.shtml", "roema01"),
        (T.camel_words, "MaxRoe", "Max Roe"),
        (M.start_time, "Start Time: 7:05 p.m. Local", "7:05 PM"),
        (M.playoff_round, "2024 ALCS Game 2", "Championship Series"),
        (M.playoff_round, "Tuesday game", None),
        (M.height_inches, "6-2, 210lb", 74),
        (M.weight_pounds, "6-2, 210lb (188cm)", 210),
        (M.hand, "Unknown", None),
        (M.hand, "Switch", "S"),
    ],
)
def test_scalars(spark, f, value, want):
    assert one(spark, value, f) == want


@pytest.mark.parametrize(("details", "n"), [("2·HR,SB", 2), ("HR", 1), ("SB,HR,2B", 1), ("2·SB", 0), (None, 0), ("HRX", 0)])
def test_detail_count(spark, details, n):
    assert one(spark, details, lambda c: T.detail_count(c, "HR")) == n


def test_detail_map_adds_repeats(spark):
    assert one(spark, "2·HR, SB,HR", T.detail_map) == {"HR": 3, "SB": 1}


def test_long_date_and_sides(spark):
    row = spark.range(1).select(M.long_date(F.lit("Monday, April 1, 2024")).alias("d"), M.winner(F.lit("A"), F.lit("B"), F.lit(3), F.lit(1)).alias("w"), M.winner(F.lit("A"), F.lit("B"), F.lit(1), F.lit(1)).alias("t"), M.innings_played(F.array(F.lit("1"), F.lit("11"), F.lit("R")), F.lit(0), F.lit("")).alias("i")).first()
    assert (str(row["d"]), row["w"], row["t"], row["i"]) == ("2024-04-01", "A", None, 11)


RULES = [
    ("Interference by Runner", "runner_interference"),
    ("Double Play: Caught stealing 2B, interference", "runner_interference"),
    ("Flyball: RF, Sacrifice Fly", "sacrifice_fly"),
    ("Bunt Groundout: P-1B/Sacrifice", "sacrifice_hit"),
    ("Intentional Walk", "walk"),
    ("Walk, Roe Caught Stealing 2B", "walk"),
    ("Hit By Pitch", "hit_by_pitch"),
    ("Strikeout Swinging, Wild Pitch; Roe to 1B", "strikeout"),
    ("Strikeout Wild Pitch", "strikeout_reached"),
    ("Double Play: Strikeout Swinging, Lee Caught Stealing 2B", "strikeout_double_play"),
    ("Wild Pitch; Roe to 3B", "running"),
    ("Balk; Roe to 2B", "running"),
    ("Reached on E6", "error"),
    ("Reached on Interference on C", "interference"),
    ("Strikeout Looking", "strikeout"),
    ("Ground Ball Double Play: Grounded into Double Play", "double_play"),
    ("Interference by batter", "batter_interference"),
    ("Groundout: SS-1B", "out"),
    ("Reach on Fielder's Choice", "out"),
    ("Home Run (Fly Ball to Deep LF)", "home_run"),
    ("Single to CF (Line Drive)", "single"),
    ("Ground-rule Double (Fly Ball)", "double"),
    ("Triple to RF", "triple"),
    ("Mound visit", None),
    ("", None),
    (None, None),
]


def test_rules_and_their_order(spark):
    rows = P.classify(spark.createDataFrame([(i, d) for i, (d, _) in enumerate(RULES)], "i int, description string")).orderBy("i").collect()
    assert [r["rule"] for r in rows] == [w for _, w in RULES]
    by = {r["rule"]: r for r in rows if r["rule"]}
    assert by["strikeout"]["is_strikeout"] and by["strikeout"]["is_out"] and by["strikeout"]["outs_recorded"] == 0
    assert by["home_run"]["hit_type"] == "home_run" and by["home_run"]["bases_reached"] == 4
    assert not by["running"]["is_plate_appearance"] and by["walk"]["is_walk"] and not by["walk"]["is_at_bat"]
    assert by["double_play"]["outs_recorded"] == 2 and rows[-1]["is_out"] is None


@pytest.mark.parametrize(("text", "n"), [("Home Run, Grand Slam", 4), ("Single; Roe Scores; Lee Scores", 2), ("Reached on error; Roe scores", 0), ("Double, 2 RBI", 2), ("Home Run; Roe Scores", 2)])
def test_runs_batted_in(spark, text, n):
    assert one(spark, text, P.runs_batted_in) == n


def test_conservative_rules(spark):
    plays = spark.createDataFrame([(0, "Walk"), (1, "Single to CF"), (2, "Wild Pitch"), (3, "Groundout: SS-1B"), (4, "Hit By Pitch"), (5, "Reached on E4")], "i int, description string")
    rows = P.pitching_outcome(P.classify(plays, rules=P.CONSERVATIVE_RULES, outcomes=P.CONSERVATIVE_OUTCOMES)).orderBy("i").collect()
    assert [r["rule"] for r in rows] == ["walk", "single", None, "out", "hit_by_pitch", None]
    assert rows[0]["bases_reached"] == 1 and rows[4]["bases_reached"] == 1 and rows[1]["hit_allowed"] and rows[3]["out_recorded"] and rows[0]["walk_allowed"]


def test_flags(spark):
    said = ["Home Run; Roe Scores", "Caught Stealing 2B", "Flyball, Sacrifice Fly; Roe Scores", "Double Play: Groundout", "Single; Lee to 3B; 1 RBI", "Fielder's Choice; Roe to home", "Stolen Base", None]
    rows = P.flags(spark.createDataFrame(list(enumerate(said)), "i int, description string")).orderBy("i").collect()
    assert [(r["hit_type"], r["rbi"], r["runs_scored"]) for r in rows[:1]] == [("home_run", 2, 2)]
    assert rows[1]["CS"] == 1 and not rows[1]["is_plate_appearance"] and rows[2]["out_type"] == "sacrifice_fly" and rows[2]["rbi"] == 1
    assert rows[3]["out_type"] == "groundout" and rows[3]["hit_type"] is None and rows[4]["rbi"] == 1 and rows[4]["advanced_to"] == ["3b"]
    assert rows[5]["is_fielders_choice"] and rows[5]["rbi"] == 0 and rows[6]["SB"] == 1 and rows[7]["is_plate_appearance"]


def test_kind(spark):
    rows = P.kind(spark.createDataFrame([(0, "Double Play: Groundout"), (1, "Doubles to left"), (2, "Homer to right"), (3, "Nothing")], "i int, description string")).orderBy("i").collect()
    assert [r["rule"] for r in rows] == ["out", "double", "home_run", None]


def test_reports_of_both_kinds(spark):
    """A status with a list, or an accuracy with counts; both in one table; overall ones and missing columns."""
    from dugout.operators import reconcile as R

    rows = [("a", "batting", "kept", 97.0, 3, 4, ["x", "y"], None, None, None), ("a", "pitching", None, None, None, None, None, 100.0, 5, 0), ("b", "batting", None, None, None, None, None, 95.0, 6, 2), ("b", "pitching", None, None, None, None, None, None, None, None), ("b", "overall", "kept", 1.0, 1, 1, [], 1.0, 1, 1)]
    table = spark.createDataFrame(rows, "game_id string, validation_type string, status string, accuracy_percentage double, total_official int, total_calculated int, discrepancies array<string>, accuracy double, players_compared int, total_differences int")
    want = {("a", "batting"): ("kept", 97.0, 3, 4, 2), ("a", "pitching"): ("success", 100.0, 5, 5, 0), ("b", "batting"): ("warning", 95.0, 6, 6, 2), ("b", "pitching"): ("failure", 0.0, 0, 0, 0)}
    assert {(r[0], r[1]): tuple(r)[2:] for r in R.report_rows(table).collect()} == want
    few = R.report_rows(table.where("accuracy = 95").select("game_id", "validation_type", "accuracy"))
    assert [tuple(r)[2:] for r in few.collect()] == [("warning", 95.0, 0, 0, 0)] and few.columns == R.REPORT.split(", ")


def test_explorer_lines(spark):
    """Words, queries over the tables, and views that were there before."""
    from dugout.plans import explorer as X

    spark.range(3).createOrReplaceTempView("mine")
    tables = {"mine": spark.range(5), "other": spark.range(7).selectExpr("id", "'x' AS v")}
    assert {tuple(r) for r in X.ask(spark, "tables", tables).collect()} == {("mine", 5, 1), ("other", 7, 2)}
    assert {tuple(r) for r in X.ask(spark, "COLUMNS;", tables).collect()} == {("mine", "id", "bigint"), ("other", "id", "bigint"), ("other", "v", "string")}
    assert {r["word"] for r in X.ask(spark, "help", {}).collect()} == set(X.HELP)
    assert X.ask(spark, "SELECT count(*) AS n FROM mine JOIN other USING (id);", tables).first()["n"] == 5
    assert spark.table("mine").count() == 3 and "other" not in {t.name for t in spark.catalog.listTables()}
    spark.catalog.dropTempView("mine")


def test_sums_of_numeric_columns(spark):
    from dugout.operators import reconcile as R

    rows = spark.createDataFrame([("a", 1, 2.5, "x"), ("a", 2, None, "y"), ("b", 3, 1.0, "z")], "k string, i int, d double, s string")
    assert {tuple(r) for r in R.summed(rows, ["k"]).collect()} == {("a", 3, 2.5), ("b", 3, 1.0)}


def test_codes_behind_names(spark):
    for raw, want in (("Ann Lee RF", "Ann Lee"), ("Ann Lee PH-LF ", "Ann Lee"), ("Ann Lee", "Ann Lee"), ("Ken Roy Jr.", "Ken Roy Jr."), (None, None)):
        assert one(spark, raw, T.without_code) == want
