"""Base-state transitions and what is credited out of them."""

from dugout.functions import plays as P
from dugout.operators import events as E


def played(spark, said, game="g"):
    plays = spark.createDataFrame([(game, i, b, "P", d) for i, (b, d) in enumerate(said)], "game_id string, seq long, batter_name string, pitcher_name string, description string")
    return P.classify(plays)


def moves(spark, said):
    rows = E.transitions(played(spark, said)).orderBy("seq", "from_base").collect()
    return [[(r["runner"], r["from_base"], r["to_base"], r["is_out"], r["how"]) for r in rows if r["seq"] == i] for i in range(len(said))]


ANN, BO, CY, DI = "Ann Lee", "Bo Diaz", "Cy Moe", "Di Fox"


def test_hits_walks_and_named_moves(spark):
    got = moves(spark, [(ANN, "Single to CF"), (BO, "Walk"), (CY, "Single to RF; Lee Scores; Diaz to 3B"), (DI, "Wild Pitch; Diaz Scores; Moe to 3B"), (DI, "Walk"), (ANN, "Double to LF; Fox out at Hm")])
    assert got == [
        [(ANN, 0, 1, False, "bat")],
        [(BO, 0, 1, False, "bat"), (ANN, 1, 2, False, "bat")],
        [(CY, 0, 1, False, "bat"), (BO, 1, 3, False, "advance"), (ANN, 2, 4, False, "run")],
        [(CY, 1, 3, False, "advance"), (BO, 3, 4, False, "run")],
        [(DI, 0, 1, False, "bat")],
        [(ANN, 0, 2, False, "bat"), (DI, 1, None, True, "out"), (CY, 3, 4, False, "bat")],
    ]


def test_double_steals_errors_and_outs(spark):
    got = moves(spark, [(ANN, "Reached on E6"), (BO, "Walk"), (CY, "Diaz Steals 2B; Lee Steals 3B"), (CY, "Ann Lee Caught Stealing home (P-C)"), (CY, "Strikeout Swinging"), (DI, "Groundout: SS-1B"), (ANN, "Single to CF")])
    assert got[2] == [(BO, 1, 2, False, "steal"), (ANN, 2, 3, False, "steal")]
    assert got[3] == [(ANN, 3, None, True, "caught")] and got[4] == [(CY, 0, None, True, "bat")] and got[5] == [(DI, 0, None, True, "bat")]
    assert got[6] == [(ANN, 0, 1, False, "bat")]  # the bases were cleared


def test_forced_runs_double_plays_and_two_on_a_base(spark):
    got = moves(spark, [(ANN, "Walk"), (BO, "Hit By Pitch"), (CY, "Walk"), (DI, "Walk"), (ANN, "Ground Ball Double Play: SS-2B-1B"), (BO, "Wild Pitch; Moe Steals 3B")])
    assert got[3] == [(DI, 0, 1, False, "bat"), (CY, 1, 2, False, "bat"), (BO, 2, 3, False, "bat"), (ANN, 3, 4, False, "bat")]
    assert got[4] == [(ANN, 0, None, True, "bat"), (DI, 1, None, True, "bat")]
    assert got[5] == [(CY, 2, 3, False, "steal"), (BO, 3, None, False, "bat")]


def test_credits(spark):
    said = [(ANN, "Walk"), (BO, "Lee Steals 2B"), (BO, "Single to CF; Lee Scores"), (CY, "Home Run (Fly Ball)"), (DI, "Triple to RF (Fly Ball)"), (ANN, "Flyball: CF/Sacrifice Fly; Fox Scores"), (BO, "Double to LF"), (CY, "Reached on E4; Diaz Scores"), (DI, "Moe Caught Stealing 2B (C-SS)"), (DI, "Strikeout Looking")]
    events = played(spark, said)
    got = {r["player"]: (r["AB"], r["H"], r["R"], r["RBI"], r["SB"], r["CS"]) for r in E.player_totals(events).collect()}
    assert got == {ANN: (0, 0, 1, 1, 1, 0), BO: (2, 2, 2, 1, 0, 0), CY: (2, 1, 1, 2, 0, 1), DI: (2, 1, 1, 0, 0, 0)}
    assert sum(r["runs"] for r in E.base_machine(events).collect()) == sum(x[2] for x in got.values()) == 5


def test_runs_are_those_of_the_base_machine(spark):
    """Over made games without named moves both machines count the same runs, game by game."""
    from dugout.plans import demo, season

    events = season.silver(demo.pages(spark, 6))["events"].cache()
    runs = {r["game_id"]: r["n"] for r in E.base_machine(events).groupBy("game_id").agg({"runs": "sum"}).withColumnRenamed("sum(runs)", "n").collect()}
    lines = {r["game_id"]: r["n"] for r in E.credits(E.transitions(events)).groupBy("game_id").agg({"R": "sum"}).withColumnRenamed("sum(R)", "n").collect()}
    assert runs == lines and sum(runs.values()) > 0
