"""Official box scores against lines computed from events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.plays import outs_on_play

BATTING = ("PA", "AB", "H", "BB", "SO", "HR", "doubles", "triples")
PITCHING = ("BF", "H", "BB", "SO", "HR")


def batter_lines(events: DataFrame, by: tuple[str, ...] = ("game_id",)) -> DataFrame:
    """A line for each batter's name; with batting_team AS team among `by`, namesakes of two sides are two."""
    hit = lambda t: F.count_if(F.col("hit_type") == t)
    return events.groupBy(*by, F.col("batter_name").alias("player_name")).agg(F.count_if("is_plate_appearance").alias("PA"), F.count_if("is_at_bat").alias("AB"), F.count_if("is_hit").alias("H"), F.count_if("is_walk").alias("BB"), F.count_if("is_strikeout").alias("SO"), hit("home_run").alias("HR"), hit("double").alias("doubles"), hit("triple").alias("triples"))


def pitcher_lines(events: DataFrame, by: tuple[str, ...] = ("game_id",)) -> DataFrame:
    return events.groupBy(*by, F.col("pitcher_name").alias("player_name")).agg(F.count_if("is_plate_appearance").alias("BF"), F.count_if("is_hit").alias("H"), F.count_if("is_walk").alias("BB"), F.count_if("is_strikeout").alias("SO"), F.count_if(F.col("hit_type") == "home_run").alias("HR"), F.sum("pitch_count").alias("PC"), F.sum(outs_on_play(events)).alias("outs"))


def differences(official: DataFrame, parsed: DataFrame, keys: list[str], stats: tuple[str, ...]) -> DataFrame:
    """(*keys, stat, official, parsed, diff) of the players in both, one row for each stat."""
    number = lambda c: F.coalesce(c.try_cast("double"), F.lit(0.0))
    a = official.select(*keys, *(F.col(s).alias(f"o_{s}") for s in stats))
    b = parsed.select(*keys, *(F.col(s).alias(f"p_{s}") for s in stats))
    cells = F.array(*(F.struct(F.lit(s).alias("stat"), number(F.col(f"o_{s}")).alias("official"), number(F.col(f"p_{s}")).alias("parsed")) for s in stats))
    return a.join(b, keys).select(*keys, F.inline(cells)).withColumn("diff", F.col("parsed") - F.col("official"))


def accuracy(diffs: DataFrame, by: list[str]) -> DataFrame:
    """Percent of the official totals that the differences leave; 0 without totals, below 0 if they exceed them.

    Beside it three other measures: the share of cells that agree, cells less the sum of differences over cells, and the
    share of players without any difference.
    """
    own = [c for c in diffs.columns if c not in (*by, "stat", "official", "parsed", "diff")]
    cell = diffs.withColumn("player", F.struct(*own) if own else F.lit(0)).groupBy(*by, "player")
    per = cell.agg(F.sum("official").alias("official"), F.sum(F.abs("diff")).alias("size"), F.count_if(F.col("diff") != 0).alias("differ"), F.count("*").alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = per.groupBy(*by).agg(F.sum("official").alias("total_official"), F.sum("size").alias("total_differences"), total("differ").alias("cells_with_differences"), total("n").alias("cells"), F.count("*").alias("players"), F.count_if(F.col("differ") > 0).alias("players_with_differences"))
    left = (F.col("total_official") - F.col("total_differences")) / F.col("total_official") * 100
    return out.withColumn("accuracy", F.when(F.col("total_official") > 0, left).otherwise(0.0)).withColumn("cell_rate", (F.col("cells") - F.col("cells_with_differences")) / F.col("cells") * 100).withColumns({
        "total_rate": (F.col("cells") - F.col("total_differences")) / F.col("cells") * 100,
        "player_rate": (F.col("players") - F.col("players_with_differences")) / F.col("players") * 100,
    }).drop("players", "players_with_differences")


def difference_texts(diffs: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, texts): each player's differences, one text for each."""
    text = F.format_string("%s: %.0f vs %.0f (diff: %+.0f)", "stat", "official", "parsed", "diff")
    return diffs.where("diff <> 0").groupBy(*keys).agg(F.sort_array(F.collect_list(text)).alias("texts"))


def provenance(official: DataFrame, parsed: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, found): left_only, right_only or both."""
    a, b = official.select(*keys).distinct().withColumn("a", F.lit(1)), parsed.select(*keys).distinct().withColumn("b", F.lit(1))
    return a.join(b, keys, "full_outer").select(*keys, F.when(F.col("b").isNull(), "left_only").when(F.col("a").isNull(), "right_only").otherwise("both").alias("found"))


def only_in(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def unmatched_categories(unmatched: DataFrame) -> DataFrame:
    """Official players without events: nothing done, pinch runners, names that differ, or other, in this order."""
    n = lambda c: F.coalesce(F.col(c), F.lit(0)) if c in unmatched.columns else F.lit(0)
    total = lambda cs: sum((n(c) for c in cs), F.lit(0))
    running = ("R", "SB", "CS")
    everything = total(("PA", "AB", "H", "BB", "SO", "HR", "doubles", "triples", "HBP", "GDP", "SF", "SH", *running))
    kind = F.when(everything == 0, "empty_stats").when((n("PA") == 0) & (n("AB") == 0) & (total(running) > 0), "pinch_runner").when((n("PA") > 0) | (n("AB") > 0), "name_mismatch").otherwise("other")
    return unmatched.withColumn("category", kind)


def status(batting: Column, pitching: Column, threshold: float = 95.0) -> Column:
    overall = F.least(batting, pitching)
    return F.when(overall >= threshold, "PASS").when(overall >= 80, "PARTIAL").otherwise("FAIL")


def report_status(value: Column) -> Column:
    return F.when(value >= 100, "success").when(value >= 95, "warning").otherwise("failure")


#: What a stored report says.
REPORT = "game_id, validation_type, status, accuracy_percentage, total_official, total_calculated, discrepancies_count"


def report_rows(checked: DataFrame) -> DataFrame:
    """Rows to store of either kind of report, without overall ones: those with a status, totals and a list of
    discrepancies, and those with an accuracy, the players compared and a number of differences, whose status follows from it.

    A table may hold both kinds; columns that it lacks count as null.
    """
    column = lambda name, kind: F.col(name) if name in checked.columns else F.lit(None).cast(kind)
    kinds = {"status": "string", "accuracy_percentage": "double", "total_official": "long", "total_calculated": "long", "discrepancies": "array<string>", "accuracy": "double", "players_compared": "long", "total_differences": "long"}
    has = {n: column(n, k) for n, k in kinds.items()}
    accuracy = F.coalesce(has["accuracy"], F.lit(0.0))
    first, compared = has["status"].isNotNull(), F.coalesce(has["players_compared"], F.lit(0)).cast("long")
    pick = lambda a, b: F.when(first, a).otherwise(b)
    values = {
        "status": pick(has["status"], report_status(accuracy)), "accuracy_percentage": pick(has["accuracy_percentage"], accuracy), "total_official": pick(has["total_official"].cast("long"), compared),
        "total_calculated": pick(has["total_calculated"].cast("long"), compared), "discrepancies_count": pick(F.coalesce(F.array_size(has["discrepancies"]), F.lit(0)).cast("long"), F.coalesce(has["total_differences"], F.lit(0)).cast("long")),
    }
    return checked.where(F.col("validation_type") != "overall").select("game_id", "validation_type", *(v.alias(n) for n, v in values.items()))


#: Columns of the comparison by side, and what they are called there.
VIEWS = {
    "batting": ({"player_id": "player_id", "player_name": "player_name", "team": "team"}, ("AB", "H", "BB", "SO", "PA", "R", "RBI", "HR", "2B", "3B", "SB", "CS", "HBP", "GDP", "SF", "SH"), {"2B": "doubles", "3B": "triples"}),
    "pitching": ({"player_id": "player_id", "player_name": "pitcher_name", "team": "team"}, ("BF", "H", "BB", "SO", "HR", "PC"), {}),
}


def validation_view(appearances: DataFrame, side: str) -> DataFrame:
    """The columns of appearances that are compared, by the comparison's names; those that are missing stay out."""
    who, stats, stored = VIEWS[side]
    wanted = who | {stored.get(s, s): s for s in stats}
    return appearances.select(*(F.col(f"`{c}`").alias(n) for c, n in wanted.items() if c in appearances.columns))


def summed(rows: DataFrame, by: list[str]) -> DataFrame:
    """All numeric columns of rows, summed by key; others are left out."""
    numeric = [f.name for f in rows.schema if f.name not in by and f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    return rows.groupBy(*by).agg(*(F.sum(c).alias(c) for c in numeric))


def storable(results: DataFrame, least: float, strict: bool = True) -> DataFrame:
    """The games to store: strict, both accuracies reach the least; else all but failures."""
    return results.where((F.least("batting_accuracy", "pitching_accuracy") >= least) if strict else (F.col("status") != "FAIL"))


def band(value: Column) -> Column:
    """Six named bands without gaps."""
    return F.when(value >= 100, "perfect").when(value >= 99.5, "excellent").when(value >= 99, "very_good").when(value >= 98, "good").when(value >= 95, "fair").otherwise("poor")


def grade(value: Column) -> Column:
    return F.when(value >= 100, "perfect").when(value >= 99, "good").otherwise("needs_work")


def accuracy_histogram(results: DataFrame, value: str = "accuracy") -> DataFrame:
    return results.groupBy(band(F.col(value)).alias("band")).agg(F.count("*").alias("games"))


def discrepancy_histogram(diffs: DataFrame) -> DataFrame:
    """(stat, total, players, worst): which stats differ, how much, and the largest single difference's size."""
    return diffs.where("diff <> 0").groupBy("stat").agg(F.sum(F.abs("diff")).alias("total"), F.count("*").alias("players"), F.max(F.abs("diff")).alias("worst"))


def discrepancy_spread(diffs: DataFrame, keys: list[str], samples: int = 5) -> DataFrame:
    """(kind, players, sample): how many players differ in one stat and in several, and a few of them, the worst first."""
    per = diffs.where("diff <> 0").groupBy(*keys).agg(F.count("*").alias("stats"), F.sum(F.abs("diff")).alias("size"))
    kind = F.when(F.col("stats") == 1, "single").otherwise("multiple")
    ranked = per.withColumn("kind", kind).withColumn("n", F.row_number().over(W.partitionBy("kind").orderBy(F.desc("size"), *keys)))
    sample = F.sort_array(F.collect_list(F.when(F.col("n") <= samples, F.struct("n", *keys))))
    return ranked.groupBy("kind").agg(F.count("*").alias("players"), sample.alias("sample"))


def score_distribution(results: DataFrame, value: str = "accuracy") -> DataFrame:
    v = F.col(value)
    return results.agg(F.count("*").alias("games"), F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"), F.stddev_pop(v).alias("spread"), F.count_if(v >= 100).alias("perfect"))


def batch_summary(results: DataFrame) -> DataFrame:
    """Counts by status, mean accuracies and their mean, totals of differences, games with any."""
    state = lambda s: F.count_if(F.col("processing_status") == s)
    out = results.agg(F.count("*").alias("games"), state("success").alias("succeeded"), state("skipped").alias("skipped"), state("error").alias("failed"), F.avg("batting_accuracy").alias("batting_accuracy"), F.avg("pitching_accuracy").alias("pitching_accuracy"), F.sum("batting_differences").alias("batting_differences"), F.sum("pitching_differences").alias("pitching_differences"), F.count_if((F.col("batting_differences") > 0) | (F.col("pitching_differences") > 0)).alias("games_with_differences"))
    return out.withColumn("overall_accuracy", (F.col("batting_accuracy") + F.col("pitching_accuracy")) / 2)


def failure_kind(error: Column) -> Column:
    low = F.lower(error)
    return F.when(low.contains("timeout"), "timeout").when(low.rlike("connection|network"), "network").when(low.rlike("no table|not found|missing"), "missing_data").when(low.rlike("parse|index|key"), "parsing").otherwise("other")


def drill_down(diffs: DataFrame, events: DataFrame, role: str = "batter") -> DataFrame:
    """The players that differ, with their differences and all of their plays in order."""
    texts = difference_texts(diffs, ["game_id", "player_name"])
    plays = events.groupBy("game_id", F.col(f"{role}_name").alias("player_name")).agg(F.sort_array(F.collect_list(F.struct("event_order", "inning", "description"))).alias("plays"))
    return texts.join(plays, ["game_id", "player_name"], "left")


def recommendations(results: DataFrame, diffs: DataFrame) -> DataFrame:
    """(recommendation): what a batch's figures call for."""
    state = results.agg(F.avg("accuracy").alias("mean"), (F.count_if(F.col("accuracy") < 95) / F.count("*")).alias("low_share"))
    stat = diffs.where("diff <> 0").groupBy("stat").agg(F.sum(F.abs("diff")).alias("n")).agg(F.max_by("stat", F.struct("n", "stat")).alias("worst"))
    advice = F.array(
        F.when(F.col("mean") < 95, "Review the play rules: the mean accuracy is below 95"),
        F.when(F.col("low_share") > 0.1, "Read the games below 95 again: they are over a tenth"),
        F.when(F.col("worst").isNotNull(), F.concat(F.lit("Look at "), F.col("worst"), F.lit(" first: it differs most"))),
    )
    both = state.unionByName(stat, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in ("mean", "low_share", "worst")))
    return both.select(F.explode(F.array_compact(advice)).alias("recommendation"))
