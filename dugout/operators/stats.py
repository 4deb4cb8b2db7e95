"""Batting and pitching lines: seasons, form, match-ups, splits, leaders and the context of a game.

Rates are NULL without a denominator; leaders and summaries show 0. They are rounded half up from exact integers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

COUNTS = ("PA", "AB", "H", "doubles", "triples", "HR", "RBI", "BB", "SO", "HBP", "SF")
#: Lines, some 200 bytes each in memory, that go to all tasks.
MOST_SENT = 1 << 18


def rate(n: Column, d: Column, scale: int = 1000) -> Column:
    """n / d to three places, half up, exact; null for d = 0."""
    return F.when(d != 0, F.floor((2 * scale * n + d) / (2 * d)) / float(scale))


def total_bases(of: Callable[[str], Column] = F.col) -> Column:
    return of("H") + of("doubles") + 2 * of("triples") + 3 * of("HR")


def rates(of: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """A line's rates from its counts, which `of` gives."""
    h, ab, pa = of("H"), of("AB"), of("PA")
    on, tb = of("H") + of("BB") + of("HBP"), total_bases(of)
    ops = rate(on * ab + tb * pa, pa * ab)
    return {"AVG": rate(h, ab), "OBP": rate(on, pa), "SLG": rate(tb, ab), "OPS": ops, "TB_per_H": rate(tb, h)}


def with_rates(lines: DataFrame) -> DataFrame:
    return lines.withColumns(rates())


def _sums(*names: str) -> list[Column]:
    return [F.sum(c).cast("long").alias(c) for c in names]


def _by_player(rows: DataFrame, parts: int | None) -> DataFrame:
    """rows dealt out by player into `parts`, so that all that follows by player and more shuffles no more; None: as Spark does it."""
    return rows.repartition(parts, "player_id") if parts else rows


def _dealt(rows: DataFrame, parts: int | None, key: str) -> DataFrame:
    """rows dealt out by key, also without `parts`, then into as many partitions as Spark takes."""
    return rows.repartition(parts, key) if parts else rows.repartition(key)


def season_lines(batting: DataFrame, games: DataFrame, regular_only: bool = True) -> DataFrame:
    """A line for each player and season."""
    g = games.where(~F.col("is_playoff")) if regular_only else games
    rows = batting.join(g.select("game_id", "season"), "game_id")
    return with_rates(rows.groupBy("player_id", "season").agg(F.count_distinct("game_id").alias("games"), *_sums(*COUNTS)))


def recent_form(batting: DataFrame, games: DataFrame, before: Column | None = None, spans: tuple[int, ...] = (5, 10, 15), parts: int | None = None) -> DataFrame:
    """PA, AB, H, HR and AVG of each player's last games, newest first; games of one date by id."""
    g = games.select("game_id", "game_date")
    rows = _by_player(batting.join(g if before is None else g.where(F.col("game_date") < before), "game_id"), parts)
    per_game = rows.groupBy("player_id", "game_id", "game_date").agg(*_sums("PA", "AB", "H", "HR"))
    numbered = per_game.withColumn("n", F.row_number().over(W.partitionBy("player_id").orderBy(F.desc("game_date"), F.desc("game_id"))))
    sums = [F.sum(F.when(F.col("n") <= k, F.col(c))).alias(f"L{k}_{c}") for k in spans for c in ("PA", "AB", "H", "HR")]
    out = numbered.where(F.col("n") <= max(spans)).groupBy("player_id").agg(*sums)
    return out.withColumns({f"L{k}_AVG": rate(F.col(f"L{k}_H"), F.col(f"L{k}_AB")) for k in spans})


def form_before(batting: DataFrame, games: DataFrame, spans: tuple[int, ...] = (5, 10, 15), parts: int | None = None) -> DataFrame:
    """For each player's game the PA, AB, H, HR and AVG of the last games before it; games of one date by id. Nulls in a first game."""
    rows = _by_player(batting.join(games.select("game_id", "game_date"), "game_id"), parts)
    per_game = rows.groupBy("player_id", "game_id", "game_date").agg(*_sums("PA", "AB", "H", "HR"))
    own = W.partitionBy("player_id").orderBy("game_date", "game_id")
    sums = {f"L{k}_{c}": F.sum(c).over(own.rowsBetween(-k, -1)) for k in spans for c in ("PA", "AB", "H", "HR")}
    out = per_game.withColumns(sums).select("player_id", "game_id", *sums)
    return out.withColumns({f"L{k}_AVG": rate(F.col(f"L{k}_H"), F.col(f"L{k}_AB")) for k in spans})


def _event_line(rows: DataFrame, *keys: str) -> DataFrame:
    hit = lambda t: F.count_if(F.col("hit_type") == t)
    lines = rows.groupBy(*keys).agg(
        F.count_distinct("game_id").alias("games"), F.count_if("is_plate_appearance").alias("PA"), F.count_if("is_at_bat").alias("AB"), F.count_if("is_hit").alias("H"),
        F.count_if("is_walk").alias("BB"), F.count_if("is_strikeout").alias("SO"), hit("double").alias("doubles"), hit("triple").alias("triples"), hit("home_run").alias("HR"),
    )
    return lines.withColumns({"AVG": rate(F.col("H"), F.col("AB")), "SLG": rate(total_bases(), F.col("AB"))})


def matchup_lines(events: DataFrame) -> DataFrame:
    """A line for each batter against each pitcher."""
    return _event_line(events, "batter_id", "pitcher_id")


def handedness_lines(events: DataFrame, games: DataFrame, players: DataFrame) -> DataFrame:
    """A line for each batter and season against right- and left-handed pitchers."""
    arms = players.select(F.col("player_id").alias("pitcher_id"), F.when(F.col("throws") == "R", "RHP").when(F.col("throws") == "L", "LHP").alias("against"))
    rows = events.join(games.select("game_id", "season"), "game_id").join(arms, "pitcher_id").where("against is not null")
    return _event_line(rows, "batter_id", "season", "against")


def venue_lines(batting: DataFrame, games: DataFrame) -> DataFrame:
    rows = batting.join(games.select("game_id", "venue"), "game_id")
    return with_rates(rows.groupBy("player_id", "venue").agg(F.count_distinct("game_id").alias("games"), *_sums(*COUNTS)))


def home_away_lines(batting: DataFrame, games: DataFrame) -> DataFrame:
    rows = batting.join(games.select("game_id", "season"), "game_id").withColumn("location", F.when(F.col("team") == "home", "Home").otherwise("Away"))
    return with_rates(rows.groupBy("player_id", "season", "location").agg(F.count_distinct("game_id").alias("games"), *_sums(*COUNTS)))


def batting_leaders(batting: DataFrame, least_pa: int = 3, n: int = 15) -> DataFrame:
    lines = batting.groupBy("player_name").agg(F.count("*").alias("games"), *_sums("PA", "AB", "H", "HR", "RBI")).where(F.col("PA") >= least_pa)
    return lines.withColumn("AVG", F.coalesce(rate(F.col("H"), F.col("AB")), F.lit(0.0))).orderBy(F.desc("AVG"), F.desc("H"), "player_name").limit(n)


def pitching_leaders(pitching: DataFrame, n: int = 10) -> DataFrame:
    lines = pitching.groupBy("player_name").agg(F.count("*").alias("games"), *_sums("BF", "SO_pitched", "BB_allowed"))
    return lines.orderBy(F.desc("SO_pitched"), F.desc("BF"), "player_name").limit(n)


def busiest_pitchers(pitching: DataFrame, n: int = 20) -> DataFrame:
    """Single pitching lines with the most batters faced."""
    return pitching.select("game_id", "player_id", "pitching_order", "BF").orderBy(F.desc("BF"), "game_id", "player_id", "pitching_order").limit(n)


def two_way_by_plate_appearances(batting: DataFrame, pitching: DataFrame, n: int = 20) -> DataFrame:
    """Those who bat and pitch in one game, most plate appearances first."""
    keys = ["game_id", "player_id"]
    lines = batting.groupBy(*keys).agg(F.sum("PA").alias("PA")).join(pitching.groupBy(*keys).agg(F.sum("BF").alias("BF")), keys)
    return lines.orderBy(F.desc("PA"), "game_id", "player_id").limit(n)


def opposing_starters(batting: DataFrame, pitching: DataFrame, players: DataFrame) -> DataFrame:
    """For each batter's game the other side's first pitcher, with the arm; nulls without one."""
    starts = pitching.where("is_starter").groupBy("game_id", "team").agg(F.min_by("player_id", F.struct("pitching_order", "player_id")).alias("pitcher_id"))
    starts = starts.join(players.select(F.col("player_id").alias("pitcher_id"), "throws"), "pitcher_id", "left")
    other = starts.select("game_id", F.when(F.col("team") == "home", "away").otherwise("home").alias("team"), "pitcher_id", "throws")
    return batting.select("game_id", "player_id", "team").distinct().join(other, ["game_id", "team"], "left")


def _sent(rows: DataFrame, n: int) -> DataFrame:
    """n rows or fewer, which go to all tasks unless there are more than MOST_SENT; then Spark chooses."""
    return F.broadcast(rows) if n <= MOST_SENT else rows


def _line_over(name: str, keys: tuple[str, ...], once: str, kept: Column | None = None) -> tuple[dict[str, Column], Column]:
    """The line of all rows of players' games with the same keys, of those where `kept` is true: its counts as columns over
    windows, and a struct made of these, whose fields are null without any. `once` is 1 on one row of each game that counts, else 0."""
    own, known = W.partitionBy(*keys), reduce(and_, (F.col(k).isNotNull() for k in keys))
    sums = {c: F.sum(F.col(x) if kept is None else F.when(kept, F.col(x))).over(own) for c, x in {"games": once, **{c: c for c in COUNTS}}.items()}
    of = lambda c: F.col(f"_{name}_{c}")
    return {f"_{name}_{c}": F.when(known, n).cast("long") for c, n in sums.items()}, F.struct(*(of(c).alias(c) for c in sums), *(r.alias(c) for c, r in rates(of).items())).alias(name)


def _form_over(number: str, spans: tuple[int, ...] = (5, 10, 15)) -> tuple[dict[str, Column], Column]:
    """form_before() as columns over windows, and a struct made of these. A game may have rows of both sides: `number` is the game's."""
    own, known = W.partitionBy("player_id").orderBy(number), F.col("player_id").isNotNull() & F.col("game_id").isNotNull()
    sums = {f"L{k}_{c}": F.when(known, F.sum(c).over(own.rangeBetween(-k, -1))) for k in spans for c in ("PA", "AB", "H", "HR")}
    averages = {f"L{k}_AVG": rate(F.col(f"_L{k}_H"), F.col(f"_L{k}_AB")) for k in spans}
    return {f"_{c}": n for c, n in sums.items()}, F.struct(*(F.col(f"_{c}").alias(c) for c in sums), *(r.alias(c) for c, r in averages.items())).alias("form")


def game_context(batting: DataFrame, pitching: DataFrame, events: DataFrame, games: DataFrame, players: DataFrame, parts: int | None = None) -> DataFrame:
    """One row for each batter's game, all as struct columns: the form before it, the season, match-up, arm, venue and
    location lines, and what is known of the game and the player. Fields of a line that there isn't are null.

    Lines, starters and games are dealt out by game and meet there, then each row moves once more, to its player, where windows
    make the form and the season, venue and location lines. Structs are made after them, so that counts which nobody reads don't
    move. Lines against pitchers, far fewer, go to the rows. `parts`: partitions of both, in proportion to the lines.
    """
    facts = [c for c in games.columns if c not in ("game_id", "season", "venue")]
    known = games.select("game_id", "season", "venue", *(F.col(c).alias(f"_{c}") for c in facts))
    home = F.coalesce(F.col("team") == "home", F.lit(False))
    first = lambda side: F.min_by("player_id", F.when(side, F.struct("pitching_order", "player_id")))
    starts = _dealt(pitching.where("is_starter"), parts, "game_id").groupBy("game_id").agg(first(home).alias("_at_home"), first(~home).alias("_away"))
    lines = _dealt(batting, parts, "game_id").groupBy("game_id", "player_id", "team").agg(*_sums(*COUNTS))
    rows = lines.join(_dealt(known, parts, "game_id"), "game_id").join(starts, "game_id", "left")
    rows = rows.withColumn("pitcher_id", F.when(F.col("team") == "home", F.col("_away")).when(F.col("team") == "away", F.col("_at_home"))).drop("_at_home", "_away")
    location = F.when(F.col("team") == "home", "Home").otherwise("Away")
    once = lambda *keys: (F.row_number().over(W.partitionBy("game_id", "player_id", *keys).orderBy("team")) == 1).cast("int")
    rows = _dealt(rows.withColumns({"_once": once(), "_once_there": once(location)}), parts, "player_id").withColumn("location", location)

    number = F.dense_rank().over(W.partitionBy("player_id").orderBy("_game_date", "game_id"))
    steps = (
        _line_over("at_location", ("player_id", "season", "location"), "_once_there"),
        _line_over("season_line", ("player_id", "season"), "_once", ~F.col("_is_playoff")),  # sorted already
        _line_over("at_venue", ("player_id", "venue"), "_once"),
        ({"_number": number}, None),
        _form_over("_number"),
    )
    rows = reduce(lambda now, step: now.withColumns(step[0]), steps, rows)
    own = ("game_id", "player_id", "team", "pitcher_id", "season", "venue", "location")
    rows = rows.select(*own, F.struct(*(F.col(f"_{c}").alias(c) for c in facts)).alias("game_info"), *(struct for _, struct in steps if struct is not None))

    rows = rows.join(players.select("player_id", F.struct(*(c for c in players.columns if c != "player_id")).alias("player_info")), "player_id", "left")
    arms = players.select(F.col("player_id").alias("pitcher_id"), "throws")
    rows = rows.join(_sent(arms, arms.count() // 4), "pitcher_id", "left")  # a quarter of a line's bytes
    rows = rows.withColumn("against", F.when(F.col("throws") == "R", "RHP").when(F.col("throws") == "L", "LHP"))
    pairs, batters = events.select("batter_id", "pitcher_id").distinct().agg(F.count("*"), F.count_distinct("batter_id")).first()
    packs = (
        ("matchup", matchup_lines(events), ("player_id", "pitcher_id"), pairs),
        ("handedness", handedness_lines(events, games, players), ("player_id", "season", "against"), 2 * batters * games.select("season").distinct().count()),
    )
    for name, found, keys, n in packs:
        found = found.withColumnRenamed("batter_id", "player_id")
        values = F.struct(*(c for c in found.columns if c not in keys)).alias(name)
        rows = rows.join(_sent(found.select(*keys, values), n), list(keys), "left")
    return rows


def innings_to_outs(innings: Column) -> Column:
    """Innings pitched as outs: 5.2 are 5 innings and 2 outs."""
    tenths = F.round(innings * 10).cast("int")
    return F.floor(tenths / 10).cast("int") * 3 + tenths % 10
