"""Player names to ids: canonical names and their aliases as rows, joined by game, the best kind of match first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Heading cells that are no names.
NO_NAMES = ("Player", "Batting", "Pitching", "Team Totals")
#: Parts that follow a last name.
SUFFIXES = r"\s+(?:Jr\.?|Sr\.?|II|III|IV)$"


def canonical(batting: DataFrame, pitching: DataFrame, by: tuple[str, ...] = ("game_id",)) -> DataFrame:
    """(*by, player_name, player_id, is_ambiguous) of both tables; a name of several players has no id."""
    one = batting.select(*by, "player_name", "player_id").unionByName(pitching.select(*by, "player_name", "player_id"))
    known = one.where("player_id is not null and player_name <> ''").groupBy(*by, "player_name").agg(F.min("player_id").alias("least"), F.max("player_id").alias("most"))
    return known.select(*by, "player_name", F.when(F.col("least") == F.col("most"), F.col("least")).alias("player_id"), (F.col("least") != F.col("most")).alias("is_ambiguous"))


def from_cells(cells: DataFrame) -> DataFrame:
    """(url, player_name) of the heading cells of players in box-score tables, out of box_pages.cells(), each name once."""
    boxes = cells.where(F.lower("table_id").rlike("batting|pitching") & F.col("is_head") & (F.col("stat") == "player"))
    named = boxes.select("url", T.normal_name(T.without_decisions("text")).alias("player_name"))
    return named.where((F.col("player_name") != "") & ~F.col("player_name").isin(*NO_NAMES)).distinct()


def _dealt(rows: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """rows dealt out by keys into `parts`, so that a task's share stays the same as they grow; None: as Spark does it."""
    return rows.repartition(parts, *keys) if parts else rows


def aliases(players: DataFrame) -> DataFrame:
    """(game_id, alias, player_id, priority) of players(game_id, player_name, player_id).

    Full name, 'F. Last', 'F Last', any case, without a suffix, and the last name; an alias of two players counts for none.
    """
    name = F.col("player_name")
    bare = F.regexp_replace(name, SUFFIXES, "")
    last, initial = F.regexp_extract(bare, r"(\S+)$", 1), F.substring(name, 1, 1)
    kinds = (name, F.concat(initial, F.lit(". "), last), F.concat(initial, F.lit(" "), last), F.lower(name), bare, last)
    rows = players.select("game_id", "player_id", F.posexplode(F.array(*kinds)).alias("priority", "alias")).where("alias <> ''")
    return rows.groupBy("game_id", "alias", "priority").agg(F.min("player_id").alias("player_id"), F.count_distinct("player_id").alias("n")).where("n = 1").drop("n")


def resolve(rows: DataFrame, players: DataFrame, name: str, out: str, parts: int | None = None) -> DataFrame:
    """rows with `out`, the id of the best alias match inside the game; null if none.

    parts: partitions of each step, in proportion to the tables; with tables dealt out by game all else stays where it is.
    """
    known = _dealt(aliases(players), parts, "game_id", "alias")
    asked = rows.select("game_id", F.col(name).alias("asked")).where("asked is not null").distinct()
    forms = asked.select("game_id", "asked", F.explode(F.array_distinct(F.array("asked", F.lower("asked"), F.regexp_replace("asked", SUFFIXES, "")))).alias("alias"))
    met = _dealt(forms, parts, "game_id", "alias").join(known, ["game_id", "alias"])
    best = _dealt(met, parts, "game_id", "asked").groupBy("game_id", "asked").agg(F.min_by("player_id", F.struct("priority", "player_id")).alias(out))
    return _dealt(rows, parts, "game_id", name).join(best.withColumnRenamed("asked", name), ["game_id", name], "left")


def name_keys(rows: DataFrame, name: str) -> DataFrame:
    """rows once for each (kind, key) by which names meet, the surest first: the name itself, the name without case, suffix
    and points, initial and last name (all behind the first word), and the last word. A key that a name hasn't is null or ''."""
    bare = F.trim(F.regexp_replace(F.lower(F.regexp_replace(name, SUFFIXES, "")), r"[.\s\u00a0]+", " "))
    rows = rows.withColumn("_bare", bare).withColumn("_rest", F.regexp_extract("_bare", r"^\S+ (?:\S )?(.+)$", 1))  # columns, so that they are made once a name
    keys = (F.col(name), F.col("_bare"), F.when(F.col("_rest") != "", F.concat_ws(" ", F.substring("_bare", 1, 1), "_rest")), F.regexp_extract("_bare", r"(\S+)$", 1))
    return rows.select("*", F.inline_outer(F.array(*(F.struct(F.lit(i).alias("kind"), k.alias("key")) for i, k in enumerate(keys))))).drop("_bare", "_rest")


def resolve_sides(asked: DataFrame, players: DataFrame) -> DataFrame:
    """asked(game_id, team, who) to (game_id, team, who, player_id, how), each name once, for players(game_id, team,
    player_name, player_id) of the same side of the game.

    A name has the players that meet it by its surest kind of key; a name of several words meets nobody by the last word alone.
    If that is one player, he it is (how: his kind of key). Of several, those go who are known by another name of the side
    already, again and again, and a name for which one is left is his (how: 'rest'). Otherwise player_id is null. A side has a few
    dozen names, so this is a fold over one small array. Names and players meet in groups, not joins: tables dealt out alike by
    game stay where they are, and as nulls fall out of the groups, no filter tells two readings of one shuffle apart.
    """
    keys = ["game_id", "team"]
    several = F.trim("who").rlike(r"\S[\s.]+\S")
    forms = name_keys(asked.select(*keys, "who", several.alias("several")), "who").where("kind = 0 or key <> '' and (kind < 3 or not several)").drop("several")
    known = name_keys(players.select(*keys, "player_id", "player_name"), "player_name").where("key <> ''").drop("player_name")
    met = forms.unionByName(known, allowMissingColumns=True).groupBy(*keys, "kind", "key").agg(F.collect_set("who").alias("whos"), F.sort_array(F.collect_set("player_id")).alias("ids"))
    pairs = met.select(*keys, "kind", "ids", F.explode("whos").alias("who")).withColumn("kind", F.when(F.size("ids") > 0, F.col("kind")))
    best = pairs.groupBy(*keys, "who").agg(F.min("kind").alias("kind"), F.min_by("ids", "kind").alias("ids"))
    kinds = F.array(*map(F.lit, ("exact", "spelling", "initial", "last")))
    how = F.when(F.size("ids") == 1, F.get(kinds, F.col("kind"))).otherwise("rest").alias("how")
    sides = best.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("who", "ids", how))).alias("names"))

    def open_(x: Column) -> Column:
        return F.size(x["ids"]) > 1

    def round_(now: Column, _: Column) -> Column:
        taken = F.flatten(F.transform(F.filter(now, lambda x: F.size(x["ids"]) == 1), lambda x: x["ids"]))
        return F.transform(now, lambda x: F.when(open_(x), x.withField("ids", F.array_except(x["ids"], taken))).otherwise(x))

    settled = F.aggregate(F.filter("names", open_), F.col("names"), round_)
    out = sides.select(*keys, F.inline_outer(F.transform(settled, lambda x: F.struct(x["who"].alias("who"), x["how"].alias("_how"), F.when(F.size(x["ids"]) == 1, F.get(x["ids"], F.lit(0))).alias("player_id")))))
    return out.select(*keys, "who", "player_id", F.when(F.col("player_id").isNotNull(), F.col("_how")).alias("how"))


def enrich(events: DataFrame, players: DataFrame) -> DataFrame:
    """events with batter_id and pitcher_id by exact name in the game, and on the side where players have a team.

    Sides are events' batting_team and pitching_team.
    """
    sided = "team" in players.columns

    def side(role: str, team: str) -> DataFrame:
        return players.select("game_id", *([F.col("team").alias(team)] if sided else []), F.col("player_name").alias(f"{role}_name"), F.col("player_id").alias(f"{role}_id"))

    for role, team in (("batter", "batting_team"), ("pitcher", "pitching_team")):
        events = events.join(side(role, team), ["game_id", *([team] if sided else []), f"{role}_name"], "left")
    return events


def unmapped(enriched: DataFrame) -> DataFrame:
    """(role, player_name, events) of the names without an id."""
    sides = [enriched.where(F.col(f"{r}_id").isNull()).groupBy(F.col(f"{r}_name").alias("player_name")).agg(F.count("*").alias("events")).select(F.lit(r).alias("role"), "player_name", "events") for r in ("batter", "pitcher")]
    return reduce(DataFrame.unionByName, sides)


def best_strategy(official: DataFrame, parsed: DataFrame, strategies: dict[str, Column]) -> DataFrame:
    """(strategy, matches): how many official names of a game each way of writing parsed names finds."""
    names = official.select("game_id", F.col("player_name").alias("key")).distinct()
    rows = parsed.select("game_id", F.explode(F.array(*(F.struct(F.lit(k).alias("strategy"), c.alias("key")) for k, c in strategies.items()))).alias("s")).select("game_id", "s.*").distinct()
    return rows.join(names, ["game_id", "key"], "left_semi").groupBy("strategy").agg(F.count("*").alias("matches"))


def last_name_wins(*sources: DataFrame) -> DataFrame:
    """(player_id, player_name) of the union; of several names, that of the last source, then the least."""
    rows = reduce(DataFrame.unionByName, (s.select("player_id", "player_name", F.lit(-i).alias("source")) for i, s in enumerate(sources)))
    return rows.groupBy("player_id").agg(F.min_by("player_name", F.struct("source", "player_name")).alias("player_name"))


def first_name_wins(*sources: DataFrame) -> DataFrame:
    """(player_id, player_name) of the union; of several names, that of the first source, then the least."""
    rows = reduce(DataFrame.unionByName, (s.select("player_id", "player_name", F.lit(i).alias("source")) for i, s in enumerate(sources)))
    return rows.groupBy("player_id").agg(F.min_by("player_name", F.struct("source", "player_name")).alias("player_name"))
