"""Play classification: ordered rules compile to one CASE expression, a table of outcomes gives the flags.

A rule set is a list of (name, text, pattern); the first rule whose pattern is found wins. `text` says which text it
reads: the whole description, or its head, which for a batter's action together with running is the part before the
first comma. OUTCOMES says what a rule means, so a set is data and every column stays inside generated code.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# The phrases of the play-by-play text.
BATTER_WORDS = (
    "strikeout", "struck out", "single", "double", "triple", "home run", "walk", "grounded out", "flied out", "lined out",
    "popped out", "hit by pitch", "sacrifice",
)
RUNNER_WORDS = ("caught stealing", "pickoff", "picked off", "wild pitch", "passed ball")
STANDARD_RULES = (
    ("runner_interference", "whole", r"caught stealing.*interference by runner|interference by runner.*caught stealing|double play.*caught stealing.*interference|caught stealing.*double play.*interference|^interference by runner|^runner interference"),
    ("sacrifice_fly", "head", r"sacrifice fly|sac fly"),
    ("sacrifice_hit", "head", r"sacrifice bunt|sac bunt|bunt.*sacrifice"),
    ("walk", "head", r"^walk\b|^intentional walk"),
    ("hit_by_pitch", "head", r"^hit by pitch|^hbp\b"),
    ("strikeout_reached", "head", r"strikeout.*wild pitch|strikeout.*passed ball|wild pitch.*strikeout|passed ball.*strikeout"),
    ("strikeout_double_play", "head", r"double play.*strikeout|strikeout.*double play"),
    ("running", "no batter", r"caught stealing|pickoff|picked off|wild pitch|passed ball|balk"),
    ("error", "head", r"reached.*error|reached.*e\d+"),
    ("interference", "head", r"reached.*interference"),
    ("strikeout", "head", r"^strikeout\b|^struck out|strikeout looking|strikeout swinging"),
    ("double_play", "head", r"grounded into double play|gdp\b|double play"),
    ("batter_interference", "head", r"interference by batter"),
    ("out", "head", r"(?:grounded out|flied out|lined out|popped out|groundout|flyout|lineout|popout|popfly|flyball|fielder's choice)\b"),
    ("home_run", "head", r"home run\b|^hr\b"),
    ("single", "head", r"^single\b.*(?:to|up|through)"),
    ("double", "head", r"^double\b.*(?:to|down)|ground-rule double"),
    ("triple", "head", r"^triple\b.*(?:to|down)"),
)
#: What a rule sets, beside is_plate_appearance = true, other flags false and numbers 0.
OUTCOMES = {
    "runner_interference": {"is_plate_appearance": False},
    "sacrifice_fly": {"is_sacrifice_fly": True, "is_out": True, "outs_recorded": 1},
    "sacrifice_hit": {"is_sacrifice_hit": True, "is_out": True, "outs_recorded": 1},
    "walk": {"is_walk": True},
    "hit_by_pitch": {},
    "strikeout_reached": {"is_at_bat": True, "is_strikeout": True},
    "strikeout_double_play": {"is_at_bat": True, "is_strikeout": True, "is_out": True, "outs_recorded": 2},
    "running": {"is_plate_appearance": False},
    "error": {"is_at_bat": True},
    "interference": {},
    "strikeout": {"is_at_bat": True, "is_strikeout": True, "is_out": True},
    "double_play": {"is_at_bat": True, "is_out": True, "outs_recorded": 2},
    "batter_interference": {"is_at_bat": True, "is_out": True, "outs_recorded": 1},
    "out": {"is_at_bat": True, "is_out": True, "outs_recorded": 1},
    "home_run": {"is_at_bat": True, "is_hit": True, "hit_type": "home_run", "bases_reached": 4},
    "single": {"is_at_bat": True, "is_hit": True, "hit_type": "single", "bases_reached": 1},
    "double": {"is_at_bat": True, "is_hit": True, "hit_type": "double", "bases_reached": 2},
    "triple": {"is_at_bat": True, "is_hit": True, "hit_type": "triple", "bases_reached": 3},
}
FLAGS = ("is_plate_appearance", "is_at_bat", "is_hit", "is_walk", "is_strikeout", "is_sacrifice_fly", "is_sacrifice_hit", "is_out")

# The phrases of both other rule sets.
#: Only plain outcomes; anything that might mean two things is left out.
CONSERVATIVE_RULES = (
    ("sacrifice_fly", "whole", r"sacrifice fly|sac fly"),
    ("sacrifice_hit", "whole", r"sacrifice bunt|sac bunt"),
    ("walk", "whole", r"^walk\b|^intentional walk"),
    ("hit_by_pitch", "whole", r"^hit by pitch|^hbp\b"),
    ("strikeout", "whole", r"^strikeout\b|^struck out"),
    ("home_run", "whole", r"^home run\b|^hr\b"),
    ("single", "whole", r"^single\b.*(?:to|up|through)"),
    ("double", "whole", r"^double\b.*(?:to|down)"),
    ("triple", "whole", r"^triple\b.*(?:to|down)"),
    ("out", "whole", r"^(?:grounded out|ground out|flied out|lined out|popped out|fouled out|groundout|flyout|lineout|popout)\b|popfly\b|flyball:|grounded into double play|gdp\b|double play"),
)
#: What the conservative rules see otherwise: a batter who walks or is hit reaches a base.
CONSERVATIVE_OUTCOMES = OUTCOMES | {"walk": {"is_walk": True, "bases_reached": 1}, "hit_by_pitch": {"bases_reached": 1}}

#: First match by result, for text of which only the outcome's kind is asked: most bases first.
OUTCOME_KIND_RULES = (
    ("home_run", "whole", r"home run|homer|\bhr\b"),
    ("triple", "whole", r"\btriples?\b"),
    ("double", "whole", r"\bdoubles?\b(?! play)"),
    ("single", "whole", r"\bsingles?\b"),
    ("walk", "whole", r"\bwalks?\b|base on balls"),
    ("hit_by_pitch", "whole", r"hit by pitch|\bhbp\b"),
    ("sacrifice_fly", "whole", r"sacrifice fly|sac fly"),
    ("sacrifice_hit", "whole", r"sacrifice bunt|sac bunt"),
    ("strikeout", "whole", r"strikeout|struck out|strikes out"),
    ("out", "whole", r"grounded|flied|lined|popped|groundout|flyout|lineout|popout|double play|forceout"),
    ("error", "whole", r"error|reached.*e\d+"),
    ("fielders_choice", "whole", r"fielder's choice"),
)


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(or_, (text.contains(w) for w in words))


def with_rule(plays: DataFrame, description: str = "description", rules: tuple[tuple[str, str, str], ...] = STANDARD_RULES) -> DataFrame:
    """plays with rule, the name of the first rule that matches; null if none does.

    The texts that the rules read are columns of their own, so that they are computed once for all patterns, and the rule
    comes out of a generator, which no filter on it passes: patterns run once a row, whatever is asked of the rule.
    """
    whole = F.lower(strip(F.coalesce(F.col(description), F.lit(""))))
    kept = [c for c in plays.columns if c != "rule"]
    texts = plays.select(*(F.col(f"`{c}`") for c in kept), whole.alias("_whole"))
    texts = texts.withColumns({"_batter": _any(F.col("_whole"), BATTER_WORDS), "_runner": _any(F.col("_whole"), RUNNER_WORDS)})
    texts = texts.withColumn("_head", F.when(F.col("_batter") & F.col("_runner"), strip(F.element_at(F.split("_whole", ","), 1))).otherwise(F.col("_whole")))
    tests = {"whole": F.col("_whole").rlike, "head": F.col("_head").rlike, "no batter": lambda p: F.col("_head").rlike(p) & ~F.col("_batter")}
    out = F
    for name, text, pattern in rules:
        out = out.when(tests[text](pattern), F.lit(name))
    return texts.select(*(F.col(f"`{c}`") for c in kept), F.inline(F.array(F.struct(out.alias("rule")))))


def outcome_table(outcomes: dict[str, dict]) -> Column:
    """A literal map from rules to all that they set."""
    kinds = {f: ("boolean", f == "is_plate_appearance") for f in FLAGS} | {"hit_type": ("string", None), "outs_recorded": ("int", 0), "bases_reached": ("int", 0)}
    rows = ((F.lit(rule), F.struct(*(F.lit(o.get(n, default)).cast(kind).alias(n) for n, (kind, default) in kinds.items()))) for rule, o in outcomes.items())
    return F.create_map(*(x for row in rows for x in row))


def classify(plays: DataFrame, description: str = "description", rules: tuple[tuple[str, str, str], ...] = STANDARD_RULES, outcomes: dict[str, dict] = OUTCOMES) -> DataFrame:
    """plays with rule and the outcome's columns, by one look into the table of outcomes; nulls where no rule matches."""
    named = with_rule(plays, description, rules)
    found = F.try_element_at(outcome_table(outcomes), F.col("rule"))
    return named.withColumns({n: found[n] for n in (*FLAGS, "hit_type", "outs_recorded", "bases_reached")})


def outs_on_play(events: DataFrame) -> Column:
    """The outs of a classified play. outs_recorded stays 0 for a strikeout; here it is one out if the
    batter doesn't reach, and a runner caught stealing is one more."""
    if "rule" in events.columns:
        struck = F.col("rule").isin(*(r for r, o in OUTCOMES.items() if o.get("is_strikeout") and o.get("is_out")))
    else:  # stored events keep the flags alone
        struck = F.col("is_strikeout") & F.col("is_out")
    own = F.greatest(F.coalesce("outs_recorded", F.lit(0)), F.coalesce(struck, F.lit(False)).cast("int"))
    if "description" not in events.columns:
        return own.cast("int")
    # A double play's two outs count the runner already.
    text = F.lower(F.coalesce("description", F.lit("")))
    caught = F.size(F.regexp_extract_all(text, F.lit("(caught stealing)"), F.lit(1)))
    return F.when(text.contains("double play"), F.greatest(own, F.lit(2) * (caught > 0).cast("int"))).otherwise(own + caught).cast("int")


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("rule").isNotNull())


def rejected(classified: DataFrame) -> DataFrame:
    """Plays that no rule knows, kept for review."""
    return classified.where(F.col("rule").isNull())


def pitching_outcome(classified: DataFrame) -> DataFrame:
    """What a classified play means for the pitcher."""
    return classified.withColumns({"hit_allowed": F.col("is_hit"), "walk_allowed": F.col("is_walk"), "home_run_allowed": F.coalesce(F.col("hit_type") == "home_run", F.lit(False)), "out_recorded": F.col("rule").isin("sacrifice_fly", "sacrifice_hit", "strikeout", "out", "double_play")})


# Words of plays that are no plate appearance; hits and outs in the order that they are looked for; and what
# marks other things in a plate appearance without a hit, in any plate appearance, and in a running play.
RUNNING_WORDS = ("stolen base", "caught stealing", "picked off", "defensive indifference", "wild pitch", "passed ball", "balk", "pickoff")
HIT_WORDS = (("home_run", "home run"), ("triple", "triple"), ("double", "^(?!.*double play).*double"), ("single", "single"))
OUT_WORDS = (
    ("sacrifice_fly", "sac fly|sacrifice fly"), ("sacrifice_bunt", "sac bunt|sacrifice bunt"), ("groundout", "groundout"), ("flyout", "flyout|flyball"), ("lineout", "lineout"), ("popup", "popup|popfly"),
    ("double_play", "double play"), ("forceout", "forceout"), ("strikeout_swinging", "strikeout swinging"), ("strikeout_looking", "strikeout looking"),
)
MARKS = {
    "no hit": {"is_walk": "^(?!.*intent).*walk", "is_hit_by_pitch": "hit by pitch|hbp", "is_strikeout": "strikeout swinging|strikeout looking"},
    "batting": {"is_reached_on_error": "reaches on e|safe on e", "is_fielders_choice": "fielder's choice"},
    "running": {"SB": "stolen base", "CS": "^(?!.*stolen base).*caught stealing"},
}


def flags(plays: DataFrame, description: str = "description") -> DataFrame:
    """plays with independent flags by key words: several may hold for one play, none drops it."""
    text = F.col("_low")
    found = lambda pattern: text.rlike(f"(?s){pattern}")

    def first(table: tuple[tuple[str, str], ...]) -> Column:
        return F.coalesce(*(F.when(found(pattern), name) for name, pattern in table))

    rows = plays.withColumn("_low", F.lower(F.coalesce(F.col(description), F.lit(""))))
    rows = rows.withColumn("is_plate_appearance", ~_any(text, RUNNING_WORDS))
    bats = F.col("is_plate_appearance")
    rows = rows.withColumns({"hit_type": F.when(bats, first(HIT_WORDS)), "out_type": F.when(bats, first(OUT_WORDS))})
    holds = {"no hit": bats & F.col("hit_type").isNull(), "batting": bats, "running": ~bats}
    rows = rows.withColumns({name: holds[when] & found(pattern) for when, marks in MARKS.items() for name, pattern in marks.items()})
    scored = F.size(F.regexp_extract_all("_low", F.lit("(to home|scores)"), F.lit(1))) + F.coalesce(F.col("hit_type") == "home_run", F.lit(False)).cast("int")
    stated = F.coalesce(F.regexp_extract("_low", r"(\d) rbi", 1).try_cast("int"), F.lit(0))
    batted_in = F.when(text.contains("rbi"), stated).when(F.col("is_reached_on_error") | F.col("is_fielders_choice"), 0).otherwise(scored)
    return rows.withColumns({
        "is_hit": F.col("hit_type").isNotNull(),
        "is_out": F.col("out_type").isNotNull(),
        "is_sacrifice": F.coalesce(F.col("out_type").startswith("sacrifice"), F.lit(False)),
        "runs_scored": F.when(bats, scored).otherwise(0),
        "rbi": F.when(bats, batted_in).otherwise(0),
        "advanced_to": F.array_distinct(F.regexp_extract_all("_low", F.lit(r"to (\d+b|home)"), F.lit(1))),
        **{n: F.col(n).cast("int") for n in MARKS["running"]},
    }).drop("_low")


def kind(plays: DataFrame, description: str = "description") -> DataFrame:
    """plays with rule from OUTCOME_KIND_RULES: the kind of outcome alone, most bases first."""
    return with_rule(plays, description, OUTCOME_KIND_RULES)


def runs_batted_in(description: Column | str) -> Column:
    """A stated number of runs batted in; else by the home run's name, else the runners who score, none on an error."""
    text = F.lower(F.col(description) if isinstance(description, str) else description)
    stated = F.regexp_extract(text, r"(\d+)\s*rbi", 1).try_cast("int")
    scoring = F.size(F.regexp_extract_all(text, F.lit(r"(\bscores?\b)"), F.lit(1)))
    homer = F.when(text.contains("grand slam"), 4).when(text.rlike(r"3-run|three-run"), 3).when(text.rlike(r"2-run|two-run"), 2).otherwise(scoring + 1)
    return F.coalesce(stated, F.when(text.contains("home run"), homer).when(text.contains("error"), 0).when(text.rlike("sacrifice fly|sac fly"), F.greatest(scoring, F.lit(1))).otherwise(scoring))
