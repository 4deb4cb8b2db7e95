"""Made-up games as pages, for trials of the season plan at any size: the box score is counted from the plays."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

BAT = ("Batting", "AB", "R", "H", "RBI", "BB", "SO", "PA", "Details")
PIT = ("Pitching", "IP", "H", "R", "ER", "BB", "SO", "HR", "BF", "Pit")
PBP = ("Inn", "Batter", "Pitcher", "Pit(cnt)", "Play Description")
#: Description, outs, and what the batter's line gains.
PLAYS = (
    ("Groundout: SS-1B", 1, ("AB",), 22), ("Flyball: CF", 1, ("AB",), 16), ("Strikeout Swinging", 1, ("AB", "SO"), 20), ("Walk", 0, ("BB",), 9), ("Hit By Pitch", 0, ("HBP",), 1),
    ("Single to CF (Line Drive)", 0, ("AB", "H"), 15), ("Double to LF (Fly Ball)", 0, ("AB", "H", "2B"), 5), ("Triple to RF (Fly Ball)", 0, ("AB", "H", "3B"), 1), ("Home Run (Fly Ball to Deep LF)", 0, ("AB", "H", "HR"), 3),
    ("Reached on E6", 0, ("AB",), 2), ("Flyball: RF, Sacrifice Fly", 1, ("SF",), 1),
)


def _row(*cells: object, head: bool = False) -> str:
    tag = "th" if head else "td"
    return "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"


def _table(name: str, heads: tuple[str, ...], rows: list[str]) -> str:
    return f"<table id='{name}'>{_row(*heads, head=True)}{''.join(rows)}</table>"


def game_page(number: int) -> tuple[str, str]:
    """(url, html) of a game of nine innings."""
    rng = random.Random(number)
    teams = {"away": f"A{chr(65 + number % 26)}X", "home": f"H{chr(65 + number // 26 % 26)}X"}
    name = lambda side, i: f"{'Ann Bea Cy Dee Ed Flo Gus Hal Ida Jo'.split()[i]} {side.title()}son{chr(97 + number % 26)}"
    link = lambda side, i, code: f"<a href='/players/x/x{side[0]}{chr(97 + i)}{number % 1000:03d}.shtml'>{name(side, i)}</a> {code}"
    lines = {(side, i): dict.fromkeys(("AB", "H", "BB", "SO", "PA", "HR", "2B", "3B", "HBP", "SF"), 0) for side in teams for i in range(9)}
    thrown = {side: dict.fromkeys(("BF", "H", "BB", "SO", "HR", "Pit"), 0) for side in teams}
    plays, turn = [], dict.fromkeys(teams, 0)
    for inning in range(1, 10):
        for side, other, half in (("away", "home", "t"), ("home", "away", "b")):
            outs = 0
            while outs < 3:
                text, out, gains, _ = rng.choices(PLAYS, [p[3] for p in PLAYS])[0]
                i, pitches = turn[side] % 9, rng.randint(1, 7)
                turn[side] += 1
                outs += out
                for g in ("PA", *gains):
                    lines[side, i][g] += 1
                for g in ("BF", *(x for x in gains if x in ("H", "BB", "SO", "HR"))):
                    thrown[other][g] += 1
                thrown[other]["Pit"] += pitches
                plays.append(_row(f"{half}{inning}", name(side, i), name(other, 9), f"{pitches},(1-1)", text))
    boxes = ""
    for side, team in teams.items():
        rows = [_row(link(side, i, "CF"), n["AB"], 0, n["H"], 0, n["BB"], n["SO"], n["PA"], ",".join(f"{n[s]}·{s}" for s in ("HR", "2B", "3B", "HBP", "SF") if n[s])) for i in range(9) for n in (lines[side, i],)]
        boxes += _table(f"{team}batting", BAT, [*rows, _row("Team Totals", *[""] * 8)])
    for side, team in teams.items():
        n = thrown[side]
        boxes += _table(f"{team}pitching", PIT, [_row(link(side, 9, ""), "9.0", n["H"], 0, 0, n["BB"], n["SO"], n["HR"], n["BF"], n["Pit"])])
    day = f"2024{4 + number // 28 % 6:02d}{1 + number % 28:02d}"
    html = f"<html><head><title>Game</title></head><body><div class='scorebox'><a href='/teams/{teams['away']}/2024'>a</a><a href='/teams/{teams['home']}/2024'>h</a></div>{boxes}{_table('play_by_play', PBP, plays)}</body></html>"
    return f"https://x.test/boxes/{teams['home']}/{teams['home']}{day}{number % 10}.shtml?n={number}", html


def pages(spark: SparkSession, n: int) -> DataFrame:
    """n games; a game's id has to tell games apart, so there are at most as many as ids."""

    def make(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([game_page(int(i)) for i in part["id"]], columns=["url", "html"])

    return spark.range(n).mapInPandas(make, "url string, html string")
