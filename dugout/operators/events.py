"""Event sequences: order, pitch counts, outs and bases, runners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.plays import outs_on_play

#: Half innings in the order they are played.
HALF_RANK = "CASE inning_half WHEN 'top' THEN 0 ELSE 1 END"


def play_rows(raw: DataFrame) -> DataFrame:
    """Rows of plays: no inning headings, and inning, description and pitcher present."""
    heading = F.coalesce(F.col("batter").rlike("(?i)top of the|bottom of the"), F.lit(False))
    return raw.where(F.col("inn").isNotNull() & F.col("description").isNotNull() & F.col("pitcher").isNotNull() & ~heading)


def half_innings(raw: DataFrame) -> DataFrame:
    """Rows whose inning is a half-inning code, t or b and digits."""
    return raw.where(F.col("inn").rlike("^[tb][0-9]+$"))


def with_sides(events: DataFrame) -> DataFrame:
    """events with batting_team and pitching_team: the visitors bat in the top halves."""
    top, bottom = F.col("inning_half") == "top", F.col("inning_half") == "bottom"
    return events.withColumns({"batting_team": F.when(top, "away").when(bottom, "home"), "pitching_team": F.when(top, "home").when(bottom, "away")})


def event_id(*parts: str) -> Column:
    """The same id for the same event, however often it is read."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts)), 256)


def dedup_pitch_counts(events: DataFrame, seq: str = "seq") -> DataFrame:
    """Pitches of a running play count with the plate appearance that goes on right after it, by the same two players."""
    w = W.partitionBy("game_id", "inning", "inning_half").orderBy(seq)
    goes_on = F.lead("is_plate_appearance").over(w) & (F.lead("batter_name").over(w) == F.col("batter_name")) & (F.lead("pitcher_name").over(w) == F.col("pitcher_name"))
    return events.withColumn("pitch_count", F.when(~F.col("is_plate_appearance") & F.coalesce(goes_on, F.lit(False)), 0).otherwise(F.col("pitch_count")))


def renumber(events: DataFrame, seq: str = "seq") -> DataFrame:
    """event_order from 1 in each game, as played."""
    return events.withColumn("event_order", F.row_number().over(W.partitionBy("game_id").orderBy("inning", F.expr(HALF_RANK), seq)))


def outs_machine(events: DataFrame, seq: str = "seq") -> DataFrame:
    """(game_id, seq, half_no, outs_before, outs_after): three outs end a half inning.

    A game is one array of its few hundred events, folded in order; the reset rules out a running sum.
    """
    games = events.groupBy("game_id").agg(F.sort_array(F.collect_list(F.struct(F.col(seq).alias("seq"), outs_on_play(events).alias("outs")))).alias("plays"))
    start = F.struct(F.lit(1).alias("half"), F.lit(0).alias("outs"), F.expr("cast(array() as array<struct<seq:bigint,half_no:int,outs_before:int,outs_after:int>>)").alias("done"))

    def step(state: Column, play: Column) -> Column:
        after = state["outs"] + F.coalesce(play["outs"], F.lit(0))
        over = after >= 3
        row = F.struct(play["seq"].cast("bigint").alias("seq"), state["half"].alias("half_no"), state["outs"].alias("outs_before"), F.least(after, F.lit(3)).cast("int").alias("outs_after"))
        return F.struct((state["half"] + over.cast("int")).alias("half"), F.when(over, 0).otherwise(after).cast("int").alias("outs"), F.concat(state["done"], F.array(row)).alias("done"))

    return games.select("game_id", F.inline(F.aggregate("plays", start, step, lambda s: s["done"])))


#: The bases that texts name, and the rules that put the batter on first without a hit.
BASES = {"1st": 1, "1b": 1, "first": 1, "2nd": 2, "2b": 2, "second": 2, "3rd": 3, "3b": 3, "third": 3, "home": 4, "hm": 4}
REACHED = ("hit_by_pitch", "error", "interference", "strikeout_reached")


def base_machine(events: DataFrame, seq: str = "seq") -> DataFrame:
    """(game_id, seq, runs, bases): who stands on the bases after each event.

    Hits move every runner by the hit's bases; walks, hit batters and those who reach on an error or interference only
    the runners who are forced. Then the running that the description names, if there is one: steals move a runner,
    those caught stealing leave and are out, those who score and still stand on a base come in. Three outs clear.
    """
    free = F.coalesce(F.col("is_walk") | F.col("rule").isin(*REACHED), F.lit(False))
    moves = runner_moves("description") if "description" in events.columns else F.expr("cast(array() as array<struct<kind:string,runner:string,to_base:string>>)")
    play = F.struct(F.col(seq).cast("bigint").alias("seq"), F.col("batter_name").alias("who"), F.col("bases_reached").alias("reach"), outs_on_play(events).alias("outs"), free.alias("free"), moves.alias("moves"))
    games = events.groupBy("game_id").agg(F.sort_array(F.collect_list(play)).alias("plays"))
    empty = F.expr("cast(array(null, null, null) as array<string>)")
    start = F.struct(empty.alias("bases"), F.lit(0).alias("outs"), F.expr("cast(array() as array<struct<seq:bigint,runs:int,bases:array<string>>>)").alias("done"))
    target = F.create_map(*(F.lit(x) for pair in BASES.items() for x in pair))

    def run(now: Column, m: Column) -> Column:
        """Bases and runs after a runner's move; a runner who isn't on a base, or is as far already, stays."""
        called = F.lower(m["runner"])
        stands = F.transform(now["bases"], lambda x: F.coalesce((F.lower(x) == called) | F.lower(x).endswith(F.concat(F.lit(" "), called)), F.lit(False)))
        place = F.array_position(stands, True).cast("int")
        to = F.when(m["kind"] == "steal", F.try_element_at(target, m["to_base"])).when(m["kind"] == "run", 4).otherwise(0)
        goes = (place > 0) & ((to == 0) | (to > place))
        runner = F.get(now["bases"], place - 1)
        bases = F.transform(now["bases"], lambda x, i: F.when(i + 1 == to, runner).when(i + 1 != place, x))
        return F.struct(F.when(goes, bases).otherwise(now["bases"]).alias("bases"), (now["runs"] + (goes & (to == 4)).cast("int")).cast("int").alias("runs"))

    def step(state: Column, p: Column) -> Column:
        b = state["bases"]
        first, second, third = (F.get(b, F.lit(i)) for i in range(3))
        forced = F.array(p["who"], F.when(first.isNotNull(), first).otherwise(second), F.when(first.isNotNull() & second.isNotNull(), second).otherwise(third))
        forced_in = (first.isNotNull() & second.isNotNull() & third.isNotNull()).cast("int")
        line = F.concat(F.array(p["who"]), b)  # home, first, second, third
        moved = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda base: F.when(base >= p["reach"], F.get(line, (base - p["reach"]).cast("int"))))
        scored = F.size(F.filter(F.slice(line, (5 - p["reach"]).cast("int"), p["reach"].cast("int")), lambda x: x.isNotNull()))
        bases = F.when(p["free"], forced).when(p["reach"] > 0, moved).otherwise(b)
        runs = F.when(p["free"], forced_in).when(p["reach"] > 0, scored).otherwise(0).cast("int")
        ran = F.aggregate(p["moves"], F.struct(bases.alias("bases"), runs.alias("runs")), run)
        outs = state["outs"] + p["outs"]
        over = outs >= 3
        bases = F.when(over, empty).otherwise(ran["bases"])
        return F.struct(bases.alias("bases"), F.when(over, 0).otherwise(outs).cast("int").alias("outs"), F.concat(state["done"], F.array(F.struct(p["seq"].alias("seq"), ran["runs"].alias("runs"), bases.alias("bases")))).alias("done"))

    return games.select("game_id", F.inline(F.aggregate("plays", start, step, lambda s: s["done"])))


def runner_moves(description: str, advances: bool = False) -> Column:
    """array<struct<kind, runner, to_base>> of a description's steals, caught steals and runs, in this order; with `advances`
    then those who go on to a base and those put out at one."""
    name = r"([A-Z][\w.'-]*(?: [A-Z][\w.'-]*)*)"
    to = r"(2nd|2B|[Ss]econd|3rd|3B|[Tt]hird|[Hh]ome)"
    kinds = [("steal", rf"{name} [Ss]teals {to}"), ("caught", rf"{name} [Cc]aught [Ss]tealing {to}"), ("run", rf"{name} [Ss]cores()")]
    if advances:
        kinds += [("advance", rf"{name} to (1B|1st|[Ff]irst|2nd|2B|[Ss]econd|3rd|3B|[Tt]hird)\b"), ("out", rf"{name} [Oo]ut at (1B|2nd|2B|[Ss]econd|3rd|3B|[Tt]hird|[Hh]ome|Hm)")]

    def found(kind: str, pattern: str) -> Column:
        both = F.arrays_zip(F.regexp_extract_all(description, F.lit(pattern), F.lit(1)).alias("r"), F.regexp_extract_all(description, F.lit(pattern), F.lit(2)).alias("b"))
        return F.transform(both, lambda x: F.struct(F.lit(kind).alias("kind"), x["r"].alias("runner"), F.nullif(F.lower(x["b"]), F.lit("")).alias("to_base")))

    every = F.concat(*(found(k, p) for k, p in kinds))
    return F.filter(F.coalesce(every, F.array().cast("array<struct<kind:string,runner:string,to_base:string>>")), lambda m: ~F.lower(m["runner"]).isin("he", "him", "she", "they", "runner"))


def runner_events(plays: DataFrame) -> DataFrame:
    """A row for each steal, caught steal and run in a description: game_id, seq, kind, runner, from_base, to_base.

    from_base, where a base is named, is the one before it.
    """
    rows = plays.select("game_id", "seq", F.inline(runner_moves("description")))
    to = F.try_element_at(F.create_map(*(F.lit(x) for pair in BASES.items() for x in pair)), F.col("to_base"))
    before = F.when(to == 2, "1st").when(to == 3, "2nd").when(to == 4, "3rd")
    return rows.select("game_id", "seq", "kind", "runner", before.alias("from_base"), "to_base")


def first_events(events: DataFrame, n: int = 10) -> DataFrame:
    """The first n events of each game, in order."""
    return events.where(F.col("event_order") <= n).orderBy("game_id", "event_order")


def event_totals(events: DataFrame, by: tuple[str, ...] = ("game_id",)) -> DataFrame:
    """Events, plate appearances and each kind of outcome, counted."""
    hit = lambda t: F.count_if(F.col("hit_type") == t)
    flags = {"plate_appearances": "is_plate_appearance", "at_bats": "is_at_bat", "hits": "is_hit", "walks": "is_walk", "strikeouts": "is_strikeout", "outs": "is_out"}
    return events.groupBy(*by).agg(F.count("*").alias("events"), *(F.count_if(c).alias(n) for n, c in flags.items()), hit("double").alias("doubles"), hit("triple").alias("triples"), hit("home_run").alias("home_runs"))


#: Rules by which nobody is batted in, although runs may score.
NOT_BATTED_IN = ("error", "strikeout_reached", "double_play", "strikeout_double_play", "strikeout")


def transitions(events: DataFrame, seq: str = "seq") -> DataFrame:
    """(game_id, seq, batter, runner, from_base, to_base, is_out, how, batted_in): everyone whose place a play changes.

    Bases are 0 (at bat) to 4 (home). A play moves its batter and those who stand on the bases: a hit all by its bases, a walk
    or a batter who reaches otherwise those who are forced, a double play takes the one on first. Then the moves that the text
    names are looked up among them: a steal or an advance to a base, a run, a runner caught stealing or put out. from_base
    is where he stood before the play, to_base where he stands after it, null for one who is out; how is the last thing that
    moved him. If two end on one base, the one from further behind has it and the other, of whom the text says nothing, has
    no to_base and is not out. A run is batted in by a plate appearance, unless by an error, a strikeout or a double play.
    """
    text = F.coalesce("description", F.lit("")) if "description" in events.columns else F.lit("")
    rows = events.withColumn("_said", text)
    free = F.coalesce(F.col("is_walk") | F.col("rule").isin(*REACHED), F.lit(False))
    credited = F.coalesce(F.col("is_plate_appearance") & ~F.col("rule").isin(*NOT_BATTED_IN), F.lit(False)) if "is_plate_appearance" in events.columns else F.coalesce(~F.col("rule").isin(*NOT_BATTED_IN), F.lit(False))
    outs, caught = outs_on_play(events), F.size(F.regexp_extract_all(F.lower(text), F.lit("(caught stealing)"), F.lit(1)))
    double = F.coalesce(F.col("rule") == "double_play", F.lit(False))
    play = F.struct(
        F.col(seq).cast("bigint").alias("seq"), F.col("batter_name").alias("who"), F.coalesce("bases_reached", F.lit(0)).alias("reach"), outs.alias("outs"), free.alias("free"), double.alias("double"),
        (double | (outs > caught)).alias("retired"), credited.alias("credited"), runner_moves("_said", advances=True).alias("moves"),
    )
    games = rows.groupBy("game_id").agg(F.sort_array(F.collect_list(play)).alias("plays"))
    row = "struct<seq:bigint,batter:string,runner:string,from_base:int,to_base:int,is_out:boolean,how:string,batted_in:boolean>"
    start = F.struct(F.expr("cast(array(null, null, null) as array<string>)").alias("bases"), F.lit(0).alias("outs"), F.expr(f"cast(array() as array<{row}>)").alias("done"))
    target = F.create_map(*(F.lit(x) for pair in BASES.items() for x in pair))

    def placed(p: Column, bases: Column) -> Column:
        """Batter and runners, each with where the batter's action takes him."""
        first, second = F.get(bases, F.lit(0)).isNotNull(), F.get(bases, F.lit(1)).isNotNull()

        def one(who: Column, i: Column) -> Column:
            forced = F.when(i == 0, 1).when(i == 1, 2).when(i == 2, F.when(first, 3).otherwise(2)).otherwise(F.when(first & second, 4).otherwise(3))
            moved = F.when(p["free"], forced).when(p["reach"] > 0, F.least(i + p["reach"], F.lit(4))).when(i > 0, i)
            gone = F.when(i == 0, p["retired"] & ~p["free"] & (p["reach"] == 0)).otherwise((i == 1) & p["double"])
            return F.struct(who.alias("runner"), i.cast("int").alias("from_base"), F.when(~gone, moved).cast("int").alias("to_base"), gone.alias("is_out"), F.lit("bat").alias("how"))

        return F.transform(F.concat(F.array(p["who"]), bases), one)

    def named(now: Column, m: Column) -> Column:
        """The runners after a move of the text; one who isn't there, is out, or is as far already stays."""
        called = F.lower(m["runner"])
        fits = F.transform(now, lambda r: F.coalesce(((F.lower(r["runner"]) == called) | F.lower(r["runner"]).endswith(F.concat(F.lit(" "), called))) & r["to_base"].isNotNull(), F.lit(False)))
        at, out = F.array_position(fits, True).cast("int") - 1, m["kind"].isin("caught", "out")
        to = F.when(m["kind"] == "run", 4).otherwise(F.try_element_at(target, m["to_base"]))

        def one(r: Column, i: Column) -> Column:
            goes = (i == at) & (out | F.coalesce(to > r["to_base"], F.lit(False)))
            return F.struct(
                r["runner"].alias("runner"), r["from_base"].alias("from_base"), F.when(goes, F.when(~out, to)).otherwise(r["to_base"]).cast("int").alias("to_base"), F.when(goes, out).otherwise(r["is_out"]).alias("is_out"),
                F.when(goes, m["kind"]).otherwise(r["how"]).alias("how"),
            )

        return F.transform(now, one)

    def step(state: Column, p: Column) -> Column:
        moved = F.aggregate(p["moves"], placed(p, state["bases"]), named)

        def ended(every: Column) -> Column:
            there = F.filter(every, lambda r: r["runner"].isNotNull())
            holder = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda base: F.array_min(F.transform(F.filter(there, lambda r: r["to_base"] == base), lambda r: r["from_base"])))
            kept = lambda r: r["to_base"].isNull() | (r["to_base"] == 4) | (F.get(holder, r["to_base"] - 1) == r["from_base"])
            settled = F.transform(there, lambda r: r.withField("to_base", F.when(kept(r), r["to_base"])))
            told = F.filter(settled, lambda r: r["is_out"] | F.coalesce(r["to_base"] != r["from_base"], r["from_base"] > 0))
            lines = F.transform(
                told,
                lambda r: F.struct(
                    p["seq"].alias("seq"), p["who"].alias("batter"), r["runner"].alias("runner"), r["from_base"].alias("from_base"), r["to_base"].alias("to_base"), r["is_out"].alias("is_out"), r["how"].alias("how"),
                    (F.coalesce(r["to_base"] == 4, F.lit(False)) & p["credited"]).alias("batted_in"),
                ),
            )
            outs = state["outs"] + F.greatest(p["outs"], F.size(F.filter(told, lambda r: r["is_out"])))
            bases = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda base: F.get(F.filter(settled, lambda r: r["to_base"] == base), F.lit(0))["runner"])
            over = outs >= 3
            return F.struct(F.when(over, F.expr("cast(array(null, null, null) as array<string>)")).otherwise(bases).alias("bases"), F.when(over, 0).otherwise(outs).cast("int").alias("outs"), F.concat(state["done"], lines).alias("done"))

        return F.get(F.transform(F.array(moved), ended), F.lit(0))

    return games.select("game_id", F.inline(F.aggregate("plays", start, step, lambda s: s["done"])))


def credits(moved: DataFrame) -> DataFrame:
    """(game_id, player, R, RBI, SB, CS) out of transitions(): runs to those who come home, runs batted in to the batter."""
    count = lambda test: F.coalesce(test, F.lit(False)).cast("int")
    runner = F.struct(F.col("runner").alias("player"), count(F.col("to_base") == 4).alias("R"), F.lit(0).alias("RBI"), count((F.col("how") == "steal") & ~F.col("is_out")).alias("SB"), count(F.col("how") == "caught").alias("CS"))
    batter = F.struct(F.col("batter").alias("player"), F.lit(0).alias("R"), count(F.col("batted_in")).alias("RBI"), F.lit(0).alias("SB"), F.lit(0).alias("CS"))
    return moved.select("game_id", F.inline(F.array(runner, batter))).groupBy("game_id", "player").agg(*(F.sum(c).cast("long").alias(c) for c in ("R", "RBI", "SB", "CS")))


def player_totals(events: DataFrame, seq: str = "seq") -> DataFrame:
    """Per game and player: times at bat, hits, runs, runs batted in, steals and caught steals, from flags and transitions."""
    bats = events.groupBy("game_id", F.col("batter_name").alias("player")).agg(F.count_if("is_at_bat").alias("AB"), F.count_if("is_hit").alias("H"))
    rest = credits(transitions(events, seq))
    return bats.join(rest, ["game_id", "player"], "full_outer").fillna(0, ["AB", "H", "R", "RBI", "SB", "CS"])
