"""One query for each operator on the driver's tables, and the SQL that says the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import metadata as M
from .functions import plays as P
from .functions import text as T
from .operators import events as E
from .operators import lineup as L
from .operators import names as N
from .operators import quality as Q
from .operators import reconcile as R
from .operators import stats as S
from .operators import store as K
from .operators import versions as V
from .plans import bridge as B
from .plans import explorer as X
from .plans import reports as RP
from .session import shared_folder, table
from .sources import box_pages as HP
from .sources import cache as C
from .sources import schedule as D
from .sources import tables as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, bridge: bool = True):
    """Registers a query; its SQL follows the bridge's common tables."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = (B.SQL if bridge else "") + sql
        return f

    return add


def _rate(n: str, d: str) -> str:
    return f"CASE WHEN {d} <> 0 THEN (2000 * ({n}) + ({d})) // (2 * ({d})) / 1000.0 END"


_COUNTS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in S.COUNTS)
_TB, _ON = "H + doubles + 2 * triples + 3 * HR", "H + BB + HBP"
_RATES = f"{_rate('H', 'AB')} AS AVG, {_rate(_ON, 'PA')} AS OBP, {_rate(_TB, 'AB')} AS SLG, {_rate(f'({_ON}) * AB + ({_TB}) * PA', 'PA * AB')} AS OPS, {_rate(_TB, 'H')} AS TB_per_H"


def _lines(keys: str, source: str) -> str:
    return f", l AS (SELECT {keys}, count(DISTINCT game_id) AS games, {_COUNTS} FROM ({source}) GROUP BY ALL) SELECT *, {_RATES} FROM l"


@query("season_line", _lines("player_id, season", "SELECT b.*, g.season FROM batting b JOIN games g USING (game_id) WHERE NOT is_playoff"))
def season_line(spark, sf):
    return S.season_lines(B.batting(spark, sf), B.games(spark, sf))


@query("season_line_year", _lines("player_id, season", "SELECT b.*, g.season FROM batting b JOIN games g USING (game_id) WHERE NOT is_playoff AND season = 1998"))
def season_line_year(spark, sf):
    return S.season_lines(B.batting(spark, sf), B.games(spark, sf).where("season = 1998"))


_FORM = ", ".join(f"CAST(sum({c}) FILTER (WHERE n <= {k}) AS BIGINT) AS L{k}_{c}" for k in (5, 10, 15) for c in ("PA", "AB", "H", "HR"))


@query(
    "recent_form_buckets",
    f""", d AS (SELECT player_id, game_id, game_date, sum(PA) AS PA, sum(AB) AS AB, sum(H) AS H, sum(HR) AS HR FROM batting JOIN games USING (game_id) WHERE game_date < DATE '2000-01-01' GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY game_date DESC, game_id DESC) AS n FROM d),
    f AS (SELECT player_id, {_FORM} FROM r WHERE n <= 15 GROUP BY player_id)
    SELECT *, {", ".join(f"{_rate(f'L{k}_H', f'L{k}_AB')} AS L{k}_AVG" for k in (5, 10, 15))} FROM f""",
)
def recent_form_buckets(spark, sf):
    return S.recent_form(*B.dealt(spark, sf, ["game_id"], B.batting(spark, sf), B.games(spark, sf)), F.lit("2000-01-01").cast("date"), parts=B.parts(spark, sf))


_EVENT_LINE = """count(DISTINCT game_id) AS games, count(*) FILTER (WHERE is_pa) AS PA, count(*) FILTER (WHERE is_ab) AS AB, count(*) FILTER (WHERE is_hit) AS H, count(*) FILTER (WHERE is_walk) AS BB,
    count(*) FILTER (WHERE is_so) AS SO, CAST(0 AS BIGINT) AS doubles, CAST(0 AS BIGINT) AS triples, count(*) FILTER (WHERE hit_type = 'home_run') AS HR"""
_EVENT_RATES = f"{_rate('H', 'AB')} AS AVG, {_rate(_TB, 'AB')} AS SLG"


@query("matchup_line", f", l AS (SELECT batter_id, pitcher_id, {_EVENT_LINE} FROM plays GROUP BY ALL) SELECT *, {_EVENT_RATES} FROM l")
def matchup_line(spark, sf):
    return S.matchup_lines(B.events(spark, sf))


@query("split_by_category", f""", j AS (SELECT p.*, g.season, CASE a.throws WHEN 'R' THEN 'RHP' ELSE 'LHP' END AS against FROM plays p JOIN games g USING (game_id) JOIN players a ON a.player_id = p.pitcher_id WHERE a.throws IS NOT NULL),
    l AS (SELECT batter_id, season, against, {_EVENT_LINE} FROM j GROUP BY ALL) SELECT *, {_EVENT_RATES} FROM l""")
def split_by_category(spark, sf):
    return S.handedness_lines(B.events(spark, sf), B.games(spark, sf), B.players(spark, sf))


@query("venue_line", _lines("player_id, venue", "SELECT b.*, g.venue FROM batting b JOIN games g USING (game_id)"))
def venue_line(spark, sf):
    return S.venue_lines(B.batting(spark, sf), B.games(spark, sf))


@query("home_away_split", _lines("player_id, season, location", "SELECT b.*, g.season, CASE team WHEN 'home' THEN 'Home' ELSE 'Away' END AS location FROM batting b JOIN games g USING (game_id)"))
def home_away_split(spark, sf):
    return S.home_away_lines(B.batting(spark, sf), B.games(spark, sf))


@query("leaders_having_topk", f""", l AS (SELECT player_name, count(*) AS games, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("PA", "AB", "H", "HR", "RBI"))} FROM batting GROUP BY player_name HAVING sum(PA) >= 3)
    SELECT *, coalesce({_rate("H", "AB")}, 0) AS AVG FROM l ORDER BY AVG DESC, H DESC, player_name LIMIT 15""")
def leaders_having_topk(spark, sf):
    return S.batting_leaders(B.batting(spark, sf))


@query("leaders_simple", "SELECT player_name, count(*) AS games, CAST(sum(BF) AS BIGINT) AS BF, CAST(sum(SO_pitched) AS BIGINT) AS SO_pitched, CAST(sum(BB_allowed) AS BIGINT) AS BB_allowed FROM pitching GROUP BY player_name ORDER BY SO_pitched DESC, BF DESC, player_name LIMIT 10")
def leaders_simple(spark, sf):
    return S.pitching_leaders(B.pitching(spark, sf))


@query("health_orphans", "SELECT p.* FROM (SELECT game_id, seq FROM plays) p WHERE game_id NOT IN (SELECT game_id FROM games WHERE season > 1995)")
def health_orphans(spark, sf):
    return Q.orphans(B.raw_plays(spark, sf).select("game_id", "seq"), B.games(spark, sf).where("season > 1995"), "game_id")


@query("health_checks", """SELECT 'orphan_batting' AS "check", count(*) AS n FROM batting WHERE game_id NOT IN (SELECT game_id FROM games)
    UNION ALL SELECT 'empty_names', count(*) FILTER (WHERE player_name IS NULL OR player_name = '') FROM batting
    UNION ALL SELECT 'games_without_date', count(*) FILTER (WHERE game_date IS NULL) FROM games
    UNION ALL SELECT 'low_accuracy', count(*) FILTER (WHERE accuracy_percentage < 95) FROM reports""")
def health_checks(spark, sf):
    return Q.health(B.batting(spark, sf), B.games(spark, sf), B.reports(spark, sf))


@query("store_summary", """SELECT (SELECT count(*) FROM games) AS games, (SELECT CAST(min(game_date) AS VARCHAR) FROM games) AS first_date, (SELECT CAST(max(game_date) AS VARCHAR) FROM games) AS last_date, (SELECT count(*) FROM batting) AS batting_rows,
    (SELECT count(*) FROM pitching) AS pitching_rows, avg(accuracy_percentage) FILTER (WHERE validation_type = 'batting') AS batting_accuracy, avg(accuracy_percentage) FILTER (WHERE validation_type = 'pitching') AS pitching_accuracy FROM reports""")
def store_summary(spark, sf):
    out = Q.store_summary(B.batting(spark, sf), B.pitching(spark, sf), B.games(spark, sf), B.reports(spark, sf))
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


_PIVOT = """SELECT game_id, game_date, max(discrepancies_count) FILTER (WHERE validation_type = 'batting') AS batting_diffs, max(discrepancies_count) FILTER (WHERE validation_type = 'pitching') AS pitching_diffs,
    max(accuracy_percentage) FILTER (WHERE validation_type = 'batting') AS batting_accuracy, max(accuracy_percentage) FILTER (WHERE validation_type = 'pitching') AS pitching_accuracy FROM reports JOIN games USING (game_id) GROUP BY ALL"""


@query("diff_pivot", f", p AS ({_PIVOT}) SELECT * REPLACE (CAST(game_date AS VARCHAR) AS game_date), coalesce(batting_diffs, 0) + coalesce(pitching_diffs, 0) AS total_diffs FROM p")
def diff_pivot(spark, sf):
    return Q.reports_by_game(B.reports(spark, sf), B.games(spark, sf)).withColumn("game_date", F.col("game_date").cast("string"))


@query("expr_order", f", p AS ({_PIVOT}) SELECT game_id, coalesce(batting_diffs, 0) + coalesce(pitching_diffs, 0) AS total_diffs FROM p ORDER BY total_diffs DESC, game_id LIMIT 20")
def expr_order(spark, sf):
    return Q.reports_by_game(B.reports(spark, sf), B.games(spark, sf)).select("game_id", "total_diffs").orderBy(F.desc("total_diffs"), "game_id").limit(20)


@query("diff_by_year_filter", "SELECT season, count(DISTINCT game_id) AS games, count(DISTINCT game_id) FILTER (WHERE discrepancies_count > 0) AS games_with_diffs, CAST(sum(discrepancies_count) AS BIGINT) AS diffs FROM reports JOIN games USING (game_id) GROUP BY season")
def diff_by_year_filter(spark, sf):
    return Q.reports_by_year(B.reports(spark, sf), B.games(spark, sf))


@query("count_by_year", "SELECT season, count(*) AS games FROM games GROUP BY season")
def count_by_year(spark, sf):
    return B.games(spark, sf).groupBy("season").agg(F.count("*").alias("games"))


@query("reprocess_set", "SELECT DISTINCT game_id FROM reports WHERE accuracy_percentage < 90 OR accuracy_percentage IS NULL OR accuracy_percentage = 0")
def reprocess_set(spark, sf):
    return Q.to_reprocess(B.reports(spark, sf), B.games(spark, sf), 90)


@query("team_frequency", "SELECT team, count(*) AS games FROM (SELECT home_team AS team FROM games UNION ALL SELECT away_team FROM games) GROUP BY team ORDER BY games DESC, team LIMIT 10")
def team_frequency(spark, sf):
    return Q.team_frequency(B.games(spark, sf))


@query("two_way_semi", "SELECT game_id, player_id FROM batting INTERSECT SELECT game_id, player_id FROM pitching")
def two_way_semi(spark, sf):
    return Q.two_way(*B.dealt(spark, sf, ["game_id", "player_id"], B.batting(spark, sf), B.pitching(spark, sf)))


@query("two_way_join_distinct", "SELECT DISTINCT b.game_id, b.player_id, b.player_name, b.PA, p.BF FROM batting b JOIN pitching p ON b.game_id = p.game_id AND b.player_id = p.player_id")
def two_way_join_distinct(spark, sf):
    b, p = B.dealt(spark, sf, ["game_id", "player_id"], B.batting(spark, sf), B.pitching(spark, sf).select("game_id", "player_id", "BF"))
    return b.select("game_id", "player_id", "player_name", "PA").join(p, ["game_id", "player_id"]).distinct()


@query("dual_role_lookup", "SELECT p.seq, b.player_name AS batter, q.player_name AS pitcher FROM plays p LEFT JOIN players b ON b.player_id = p.batter_id LEFT JOIN players q ON q.player_id = p.pitcher_id")
def dual_role_lookup(spark, sf):
    who = B.players(spark, sf)
    b, q = (who.select(F.col("player_id").alias(f"{r}_id"), F.col("player_name").alias(r)) for r in ("batter", "pitcher"))
    return B.raw_plays(spark, sf).select("seq", "batter_id", "pitcher_id").join(b, "batter_id", "left").join(q, "pitcher_id", "left").select("seq", "batter", "pitcher")


@query("box_vs_events_left", """SELECT b.game_id, b.player_id, CAST(sum(b.n) AS BIGINT) AS box_rows, coalesce(any_value(e.n), 0) AS plays
    FROM (SELECT game_id, player_id, count(*) AS n FROM batting GROUP BY ALL) b LEFT JOIN (SELECT game_id, batter_id AS player_id, count(*) AS n FROM plays GROUP BY ALL) e ON b.game_id = e.game_id AND b.player_id = e.player_id GROUP BY ALL""")
def box_vs_events_left(spark, sf):
    box = B.batting(spark, sf).groupBy("game_id", "player_id").agg(F.count("*").alias("box_rows"))
    plays = B.raw_plays(spark, sf).groupBy("game_id", F.col("batter_id").alias("player_id")).agg(F.count("*").alias("plays"))
    return box.join(plays, ["game_id", "player_id"], "left").fillna(0, ["plays"])


@query("opposing_starter", """, s AS (SELECT game_id, team, arg_min(player_id, pitching_order * 1000 + player_id) AS pitcher_id FROM pitching WHERE is_starter GROUP BY ALL),
    o AS (SELECT game_id, CASE team WHEN 'home' THEN 'away' ELSE 'home' END AS team, pitcher_id, throws FROM s LEFT JOIN players ON player_id = pitcher_id)
    SELECT b.game_id, b.team, b.player_id, o.pitcher_id, o.throws FROM (SELECT DISTINCT game_id, player_id, team FROM batting) b LEFT JOIN o ON b.game_id = o.game_id AND b.team = o.team""")
def opposing_starter(spark, sf):
    return S.opposing_starters(B.batting(spark, sf), B.pitching(spark, sf), B.players(spark, sf))


@query("full_outer_provenance", """SELECT coalesce(a.game_id, b.game_id) AS game_id, coalesce(a.player_id, b.player_id) AS player_id, CASE WHEN b.game_id IS NULL THEN 'left_only' WHEN a.game_id IS NULL THEN 'right_only' ELSE 'both' END AS found
    FROM (SELECT DISTINCT game_id, player_id FROM batting) a FULL OUTER JOIN (SELECT DISTINCT game_id, player_id FROM pitching) b ON a.game_id = b.game_id AND a.player_id = b.player_id""")
def full_outer_provenance(spark, sf):
    return R.provenance(*B.dealt(spark, sf, ["game_id", "player_id"], B.batting(spark, sf), B.pitching(spark, sf)), ["game_id", "player_id"])


@query("id_enrichment", "SELECT p.seq, b.player_id AS batter_id FROM plays p LEFT JOIN (SELECT DISTINCT game_id, player_id, 'B' || player_id AS name FROM batting) b ON p.game_id = b.game_id AND p.batter_name = b.name")
def id_enrichment(spark, sf):
    known = B.batting(spark, sf).select("game_id", "player_id", F.concat(F.lit("B"), "player_id").alias("player_name"))
    none = known.limit(0)
    rows = B.raw_plays(spark, sf).select("game_id", "seq", "batter_name", "pitcher_name")
    return N.enrich(rows, N.canonical(known, none)).select("seq", "batter_id")


@query("unmapped_names", """SELECT 'batter' AS role, batter_name AS player_name, count(*) AS events FROM plays p WHERE NOT EXISTS (SELECT 1 FROM batting b WHERE b.game_id = p.game_id AND 'B' || b.player_id = p.batter_name) GROUP BY ALL
    UNION ALL SELECT 'pitcher', pitcher_name, count(*) FROM plays p WHERE NOT EXISTS (SELECT 1 FROM batting b WHERE b.game_id = p.game_id AND 'B' || b.player_id = p.pitcher_name) GROUP BY ALL""")
def unmapped_names(spark, sf):
    known = B.batting(spark, sf).select("game_id", "player_id", F.concat(F.lit("B"), "player_id").alias("player_name"))
    rows = B.raw_plays(spark, sf).select("game_id", "seq", "batter_name", "pitcher_name")
    return N.unmapped(N.enrich(rows, N.canonical(known, known.limit(0))))


@query("name_diff_both_ways", """SELECT 'official' AS side, game_id, player_id FROM (SELECT game_id, player_id FROM batting EXCEPT SELECT game_id, player_id FROM pitching)
    UNION ALL SELECT 'parsed', game_id, player_id FROM (SELECT game_id, player_id FROM pitching EXCEPT SELECT game_id, player_id FROM batting)""")
def name_diff_both_ways(spark, sf):
    keys = ["game_id", "player_id"]
    a, b = B.dealt(spark, sf, keys, B.batting(spark, sf), B.pitching(spark, sf))
    one = lambda side, df: df.select(F.lit(side).alias("side"), *keys)
    return one("official", R.only_in(a, b, keys)).unionByName(one("parsed", R.only_in(b, a, keys)))


_DIFFS = """, o AS (SELECT game_id, player_id, sum(PA) AS PA, sum(SO) AS SO FROM batting GROUP BY ALL), c AS (SELECT game_id, player_id, sum(BF) AS PA, sum(SO_pitched) AS SO FROM pitching GROUP BY ALL),
    d AS (SELECT game_id, player_id, 'PA' AS stat, CAST(o.PA AS DOUBLE) AS official, CAST(c.PA AS DOUBLE) AS parsed FROM o JOIN c USING (game_id, player_id) UNION ALL SELECT game_id, player_id, 'SO', CAST(o.SO AS DOUBLE), CAST(c.SO AS DOUBLE) FROM o JOIN c USING (game_id, player_id)),
    x AS (SELECT *, parsed - official AS diff FROM d)"""


def _diffs(spark, sf, by=None):
    """The differences, dealt out by game and player, or after that by other keys."""
    keys = ["game_id", "player_id"]
    o, c = B.dealt(spark, sf, keys, B.batting(spark, sf), B.pitching(spark, sf))
    o = o.groupBy(*keys).agg(F.sum("PA").alias("PA"), F.sum("SO").alias("SO"))
    c = c.groupBy(*keys).agg(F.sum("BF").alias("PA"), F.sum("SO_pitched").alias("SO"))
    diffs = R.differences(o, c, keys, ("PA", "SO"))
    return B.dealt(spark, sf, by, diffs)[0] if by else diffs


@query("reconcile_accuracy", f"""{_DIFFS} SELECT game_id, sum(official) AS total_official, sum(abs(diff)) AS total_differences, count(*) FILTER (WHERE diff <> 0) AS cells_with_differences, count(*) AS cells,
    CASE WHEN sum(official) > 0 THEN (sum(official) - sum(abs(diff))) / sum(official) * 100 ELSE 0 END AS accuracy, (count(*) - count(*) FILTER (WHERE diff <> 0)) / count(*) * 100 AS cell_rate,
    (count(*) - sum(abs(diff))) / count(*) * 100 AS total_rate, (count(DISTINCT player_id) - count(DISTINCT player_id) FILTER (WHERE diff <> 0)) / count(DISTINCT player_id) * 100 AS player_rate FROM x GROUP BY game_id""")
def reconcile_accuracy(spark, sf):
    return R.accuracy(_diffs(spark, sf, ["game_id"]), ["game_id"])


@query("discrepancy_unpivot", f"{_DIFFS} SELECT stat, sum(abs(diff)) AS total, count(*) AS players, max(abs(diff)) AS worst FROM x WHERE diff <> 0 GROUP BY stat")
def discrepancy_unpivot(spark, sf):
    return R.discrepancy_histogram(_diffs(spark, sf))


@query("difference_texts", f"""{_DIFFS} SELECT game_id, player_id, string_agg(stat || ': ' || CAST(official AS BIGINT) || ' vs ' || CAST(parsed AS BIGINT) || ' (diff: ' || CASE WHEN diff > 0 THEN '+' ELSE '' END || CAST(diff AS BIGINT) || ')', '; ' ORDER BY stat) AS texts
    FROM x WHERE diff <> 0 GROUP BY ALL""")
def difference_texts(spark, sf):
    return R.difference_texts(_diffs(spark, sf), ["game_id", "player_id"]).withColumn("texts", F.array_join("texts", "; "))


@query("unmatched_categories", """SELECT game_id, player_id, row_idx, CASE WHEN PA + AB + H + R = 0 THEN 'empty_stats' WHEN PA = 0 AND AB = 0 AND R > 0 THEN 'pinch_runner' WHEN PA > 0 OR AB > 0 THEN 'name_mismatch' ELSE 'other' END AS category
    FROM (SELECT game_id, player_id, row_idx, PA * (part % 2) AS PA, AB * (part % 2) AS AB, H * (part % 2) AS H, R FROM batting)""")
def unmatched_categories(spark, sf):
    rows = B.batting(spark, sf).selectExpr("game_id", "player_id", "row_idx", "PA * (part % 2) AS PA", "AB * (part % 2) AS AB", "H * (part % 2) AS H", "R")
    return R.unmatched_categories(rows).select("game_id", "player_id", "row_idx", "category")


@query("status_bands", f", p AS ({_PIVOT}) SELECT game_id, CASE WHEN least(batting_accuracy, pitching_accuracy) >= 95 THEN 'PASS' WHEN least(batting_accuracy, pitching_accuracy) >= 80 THEN 'PARTIAL' ELSE 'FAIL' END AS status FROM p")
def status_bands(spark, sf):
    return Q.reports_by_game(B.reports(spark, sf), B.games(spark, sf)).select("game_id", R.status(F.col("batting_accuracy"), F.col("pitching_accuracy")).alias("status"))


@query("store_gate", f", p AS ({_PIVOT}) SELECT game_id FROM p WHERE batting_accuracy >= 90 AND pitching_accuracy >= 90")
def store_gate(spark, sf):
    both = Q.reports_by_game(B.reports(spark, sf), B.games(spark, sf)).where("batting_accuracy is not null and pitching_accuracy is not null")
    return R.storable(both, 90).select("game_id")


@query("accuracy_histogram", """SELECT CASE WHEN accuracy_percentage >= 100 THEN 'perfect' WHEN accuracy_percentage >= 99.5 THEN 'excellent' WHEN accuracy_percentage >= 99 THEN 'very_good' WHEN accuracy_percentage >= 98 THEN 'good'
    WHEN accuracy_percentage >= 95 THEN 'fair' ELSE 'poor' END AS band, count(*) AS games FROM reports GROUP BY 1""")
def accuracy_histogram(spark, sf):
    return R.accuracy_histogram(B.reports(spark, sf), "accuracy_percentage")


@query("score_distribution", "SELECT count(*) AS games, round(avg(accuracy_percentage), 6) AS mean, min(accuracy_percentage) AS low, max(accuracy_percentage) AS high, round(stddev_pop(accuracy_percentage), 6) AS spread, count(*) FILTER (WHERE accuracy_percentage >= 100) AS perfect FROM reports")
def score_distribution(spark, sf):
    return R.score_distribution(B.reports(spark, sf), "accuracy_percentage").withColumns({c: F.round(c, 6) for c in ("mean", "spread")})


@query("batch_summary", """, p AS (SELECT *, CASE WHEN game_id % 10 = 0 THEN 'skipped' WHEN game_id % 10 = 1 THEN 'error' ELSE 'success' END AS s FROM (SELECT game_id, coalesce(max(accuracy_percentage) FILTER (WHERE validation_type = 'batting'), 0) AS b, coalesce(max(accuracy_percentage) FILTER (WHERE validation_type = 'pitching'), 0) AS p,
    max(discrepancies_count) FILTER (WHERE validation_type = 'batting') AS bd, max(discrepancies_count) FILTER (WHERE validation_type = 'pitching') AS pd FROM reports GROUP BY game_id))
    SELECT count(*) AS games, count(*) FILTER (WHERE s = 'success') AS succeeded, count(*) FILTER (WHERE s = 'skipped') AS skipped, count(*) FILTER (WHERE s = 'error') AS failed, round(avg(b), 6) AS batting_accuracy, round(avg(p), 6) AS pitching_accuracy,
    CAST(sum(bd) AS BIGINT) AS batting_differences, CAST(sum(pd) AS BIGINT) AS pitching_differences, count(*) FILTER (WHERE bd > 0 OR pd > 0) AS games_with_differences, round((avg(b) + avg(p)) / 2, 6) AS overall_accuracy FROM p""")
def batch_summary(spark, sf):
    rows = Q.reports_by_game(B.reports(spark, sf), B.games(spark, sf)).fillna(0.0, ["batting_accuracy", "pitching_accuracy"])
    rows = rows.withColumnsRenamed({"batting_diffs": "batting_differences", "pitching_diffs": "pitching_differences"})
    state = F.when(F.col("game_id") % 10 == 0, "skipped").when(F.col("game_id") % 10 == 1, "error").otherwise("success")
    return R.batch_summary(rows.withColumn("processing_status", state)).withColumns({c: F.round(c, 6) for c in ("batting_accuracy", "pitching_accuracy", "overall_accuracy")})


_ERRORS = ("Read timeout after 30 s", "Connection reset", "NETWORK down", "no table with this id", "page Not Found", "missing column", "could not parse", "list index out of range", "KeyError", "disk full")


@query("failure_kinds", "SELECT CASE WHEN doc_id % 10 = 0 THEN 'timeout' WHEN doc_id % 10 <= 2 THEN 'network' WHEN doc_id % 10 <= 5 THEN 'missing_data' WHEN doc_id % 10 <= 8 THEN 'parsing' ELSE 'other' END AS kind, count(*) AS n FROM documents GROUP BY 1", False)
def failure_kinds(spark, sf):
    error = F.get(F.array(*map(F.lit, _ERRORS)), (F.col("doc_id") % 10).cast("int"))
    return table(spark, sf, "documents").groupBy(R.failure_kind(error).alias("kind")).agg(F.count("*").alias("n"))


@query("pitch_dedup_lead", """SELECT seq, CASE WHEN NOT is_pa AND coalesce(lead(is_pa) OVER w AND lead(batter_name) OVER w = batter_name AND lead(pitcher_name) OVER w = pitcher_name, FALSE) THEN 0 ELSE pitch_count END AS pitch_count
    FROM plays WINDOW w AS (PARTITION BY game_id, inning, inning_half ORDER BY seq)""")
def pitch_dedup_lead(spark, sf):
    return E.dedup_pitch_counts(B.events(spark, sf)).select("seq", "pitch_count")


@query("event_renumber", "SELECT seq, row_number() OVER (PARTITION BY game_id ORDER BY inning, CASE inning_half WHEN 'top' THEN 0 ELSE 1 END, seq) AS event_order FROM plays")
def event_renumber(spark, sf):
    return E.renumber(B.events(spark, sf)).select("seq", "event_order")


@query("outs_machine", """, o AS (SELECT game_id, seq, is_so::INT AS out, sum(is_so::INT) OVER (PARTITION BY game_id ORDER BY seq) AS total FROM plays)
    SELECT game_id, seq, CAST((total - out) // 3 + 1 AS INT) AS half_no, CAST((total - out) % 3 AS INT) AS outs_before, CAST((total - out) % 3 + out AS INT) AS outs_after FROM o""")
def outs_machine(spark, sf):
    return E.outs_machine(B.events(spark, sf))


_BASE_SQL = B.SQL.replace("WITH games", "WITH RECURSIVE games", 1) + """, o AS (SELECT game_id, seq, batter_name AS who, hit_type, event_type IN ('signup', 'error') AS free, is_so, row_number() OVER (PARTITION BY game_id ORDER BY seq) AS k FROM plays),
    r AS (
      SELECT game_id, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS b1, CAST(NULL AS VARCHAR) AS b2, CAST(NULL AS VARCHAR) AS b3, 0 AS outs, 0 AS runs FROM o GROUP BY game_id
      UNION ALL
      SELECT o.game_id, o.k, o.seq,
        CASE WHEN r.outs + o.is_so::INT >= 3 THEN NULL WHEN o.free THEN o.who WHEN o.hit_type = 'single' THEN o.who WHEN o.hit_type = 'home_run' THEN NULL ELSE b1 END,
        CASE WHEN r.outs + o.is_so::INT >= 3 THEN NULL WHEN o.free THEN coalesce(b1, b2) WHEN o.hit_type = 'single' THEN b1 WHEN o.hit_type = 'home_run' THEN NULL ELSE b2 END,
        CASE WHEN r.outs + o.is_so::INT >= 3 THEN NULL WHEN o.free THEN CASE WHEN b1 IS NOT NULL AND b2 IS NOT NULL THEN b2 ELSE b3 END WHEN o.hit_type = 'single' THEN b2 WHEN o.hit_type = 'home_run' THEN NULL ELSE b3 END,
        CASE WHEN r.outs + o.is_so::INT >= 3 THEN 0 ELSE r.outs + o.is_so::INT END,
        CASE WHEN o.free THEN (b1 IS NOT NULL AND b2 IS NOT NULL AND b3 IS NOT NULL)::INT WHEN o.hit_type = 'single' THEN (b3 IS NOT NULL)::INT WHEN o.hit_type = 'home_run' THEN 1 + (b1 IS NOT NULL)::INT + (b2 IS NOT NULL)::INT + (b3 IS NOT NULL)::INT ELSE 0 END
      FROM r JOIN o ON o.game_id = r.game_id AND o.k = r.k + 1
    ) SELECT game_id, seq, runs, coalesce(b1, '-') || ',' || coalesce(b2, '-') || ',' || coalesce(b3, '-') AS bases FROM r WHERE k > 0"""


@query("base_machine", _BASE_SQL, False)
def base_machine(spark, sf):
    return E.base_machine(B.events(spark, sf)).withColumn("bases", F.array_join("bases", ",", "-"))


def _rows(spark, sf):
    """Box-score rows with one order in each game and team."""
    rows = B.batting(spark, sf).withColumn("row_idx", F.col("row_idx") * 1_000_000 + F.col("part"))
    code = F.when(F.col("part") % 5 == 0, "PH").when(F.col("part") % 5 == 1, "P").when(F.col("part") % 5 == 2, "PR").otherwise("SS")
    return rows.groupBy("game_id", "team", "row_idx").agg(F.min("player_id").alias("player_id"), F.min("PA").alias("PA"), F.min("AB").alias("AB"), F.min("flag").alias("flag"), F.min("part").alias("part"), F.min("player_name").alias("player_name")).withColumns({"positions": F.array(code), "is_indented": F.col("flag") == "R"})


_ROWS = """, rows AS (SELECT game_id, team, row_idx * 1000000 + part AS row_idx, min(player_id) AS player_id, min(PA) AS PA, min(AB) AS AB, min(flag) AS flag, min(part) AS part FROM batting GROUP BY game_id, team, row_idx * 1000000 + part),
    coded AS (SELECT *, CASE part % 5 WHEN 0 THEN 'PH' WHEN 1 THEN 'P' WHEN 2 THEN 'PR' ELSE 'SS' END AS code FROM rows), b AS (SELECT *, code IN ('PH', 'PR') OR flag = 'R' AS sub FROM coded)"""


@query("batting_order_running", f"""{_ROWS}, n AS (SELECT *, coalesce(sum(CASE WHEN sub THEN 0 ELSE 1 END) OVER (PARTITION BY game_id, team ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b)
    SELECT game_id, team, row_idx, CAST(CASE WHEN NOT sub THEN k + 1 WHEN PA > 0 THEN greatest(1, k) END AS BIGINT) AS batting_order, sub AS is_substitute FROM n""")
def batting_order_running(spark, sf):
    return L.batting_order(_rows(spark, sf)).select("game_id", "team", "row_idx", F.col("batting_order").cast("long").alias("batting_order"), "is_substitute")


@query("first_nine", f"""{_ROWS}, n AS (SELECT *, code NOT IN ('P', 'PR') AND (PA > 0 OR AB > 0) AS plays FROM b), k AS (SELECT *, sum(CASE WHEN plays THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, team ORDER BY row_idx) AS c FROM n)
    SELECT game_id, team, row_idx, CAST(CASE WHEN plays AND c <= 9 THEN c END AS BIGINT) AS batting_order FROM k""")
def first_nine(spark, sf):
    return L.first_nine(_rows(spark, sf)).select("game_id", "team", "row_idx", F.col("batting_order").cast("long").alias("batting_order"))


@query("position_replacement", f"""{_ROWS}, s AS (SELECT game_id, team, code, arg_min(row_idx, row_idx) AS first_row FROM b WHERE NOT sub GROUP BY ALL) SELECT b.game_id, b.team, b.row_idx, s.first_row AS replaced FROM b LEFT JOIN s USING (game_id, team, code) WHERE sub""")
def position_replacement(spark, sf):
    rows = L.batting_order(_rows(spark, sf)).withColumn("player_name", F.col("row_idx"))
    return L.positional_substitutes(rows.where("is_starter"), rows.where("is_substitute")).select("game_id", "team", "row_idx", F.col("replaced_player").alias("replaced"))


@query("low_pa_candidate", f"""{_ROWS}, n AS (SELECT *, row_number() OVER (PARTITION BY game_id, team ORDER BY row_idx) AS o FROM b WHERE NOT sub), m AS (SELECT *, avg(PA) OVER (PARTITION BY game_id, team) AS mean_pa FROM n)
    SELECT game_id, team, min(o) AS candidate_order FROM m WHERE PA < 0.7 * mean_pa GROUP BY ALL""")
def low_pa_candidate(spark, sf):
    return L.low_pa_candidate(L.batting_order(_rows(spark, sf)).where("is_starter")).withColumn("candidate_order", F.col("candidate_order").cast("long"))


@query("indexed_order", f"{_ROWS}, n AS (SELECT *, row_number() OVER (PARTITION BY game_id, team ORDER BY row_idx) AS o FROM b) SELECT game_id, team, row_idx, o <= 9 AS is_starter FROM n")
def indexed_order(spark, sf):
    return L.indexed_order(_rows(spark, sf)).select("game_id", "team", "row_idx", "is_starter")


@query("pitching_order", "SELECT game_id, team, pitching_order AS line, row_number() OVER (PARTITION BY game_id, team ORDER BY pitching_order, player_id, BF) AS place FROM pitching")
def pitching_order(spark, sf):
    rows = B.pitching(spark, sf).withColumn("row_idx", F.struct("pitching_order", "player_id", "BF")).withColumnRenamed("pitching_order", "line")
    return L.pitching_order(rows).select("game_id", "team", "line", F.col("pitching_order").cast("long").alias("place"))


@query("top_games", "SELECT * REPLACE (CAST(game_date AS VARCHAR) AS game_date) FROM games ORDER BY game_date DESC, game_id LIMIT 20")
def top_games(spark, sf):
    return B.games(spark, sf).orderBy(F.desc("game_date"), "game_id").limit(20).withColumn("game_date", F.col("game_date").cast("string"))


@query("top_batting_lines", "SELECT game_id, player_id, row_idx, H, HR FROM batting ORDER BY H DESC, HR DESC, game_id, player_id, row_idx LIMIT 20")
def top_batting_lines(spark, sf):
    return B.batting(spark, sf).select("game_id", "player_id", "row_idx", "H", "HR").orderBy(F.desc("H"), F.desc("HR"), "game_id", "player_id", "row_idx").limit(20)


@query("worst_accuracy", "SELECT game_id, validation_type, accuracy_percentage, discrepancies_count FROM reports ORDER BY accuracy_percentage NULLS LAST, discrepancies_count DESC, game_id, validation_type LIMIT 20")
def worst_accuracy(spark, sf):
    return B.reports(spark, sf).orderBy(F.asc_nulls_last("accuracy_percentage"), F.desc("discrepancies_count"), "game_id", "validation_type").limit(20)


@query("freq_head_tail", """, c AS (SELECT batter_name AS value, count(*) AS n FROM plays GROUP BY 1) SELECT * FROM (SELECT *, 'head' AS "end" FROM c ORDER BY n DESC, value LIMIT 10) UNION ALL SELECT * FROM (SELECT *, 'tail' AS "end" FROM c ORDER BY n, value LIMIT 10)""")
def freq_head_tail(spark, sf):
    return Q.frequencies(B.raw_plays(spark, sf), "batter_name")


@query("union_players_first_wins", """, u AS (SELECT player_id, 'B' || min(player_name) AS n, 0 AS s FROM batting WHERE flag = 'R' GROUP BY 1 UNION ALL SELECT player_id, 'P' || min(player_name), 1 FROM pitching GROUP BY 1) SELECT player_id, arg_min(n, s) AS player_name FROM u GROUP BY player_id""")
def union_players_first_wins(spark, sf):
    b = B.batting(spark, sf).where("flag = 'R'").select("player_id", F.concat(F.lit("B"), "player_name").alias("player_name"))
    p = B.pitching(spark, sf).select("player_id", F.concat(F.lit("P"), "player_name").alias("player_name"))
    return N.first_name_wins(b, p)


@query("upsert_last_wins", "SELECT game_id, CASE WHEN season >= 1998 THEN venue || '!' ELSE venue END AS venue FROM games WHERE season <= 1998 UNION ALL SELECT game_id, venue || '!' FROM games WHERE season > 1998")
def upsert_last_wins(spark, sf):
    g = B.games(spark, sf)
    return K.upsert(g.where("season <= 1998").select("game_id", "venue"), g.where("season >= 1998").select("game_id", F.concat("venue", F.lit("!")).alias("venue")), ["game_id"], ["venue"])


@query("insert_if_absent", "SELECT game_id, venue FROM games WHERE season <= 1998 UNION ALL SELECT game_id, venue || '!' FROM games WHERE season > 1998")
def insert_if_absent(spark, sf):
    g = B.games(spark, sf)
    return K.insert_if_absent(g.where("season <= 1998").select("game_id", "venue"), g.where("season >= 1998").select("game_id", F.concat("venue", F.lit("!")).alias("venue")), ["game_id"], ["venue"])


@query("cascade_delete", "SELECT 'games' AS table_name, count(*) AS n FROM games WHERE season <> 1998 UNION ALL SELECT 'batting', count(*) FROM batting WHERE game_id IN (SELECT game_id FROM games WHERE season <> 1998) UNION ALL SELECT 'pitching', count(*) FROM pitching WHERE game_id IN (SELECT game_id FROM games WHERE season <> 1998)")
def cascade_delete(spark, sf):
    tables = {"games": B.games(spark, sf), "batting": B.batting(spark, sf), "pitching": B.pitching(spark, sf)}
    kept = K.delete_games(tables, tables["games"].where("season = 1998"))
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in kept.items()))


@query("delete_dry_run", "SELECT 'games' AS table_name, count(*) AS n FROM games WHERE season = 1998 UNION ALL SELECT 'batting', count(*) FROM batting WHERE game_id IN (SELECT game_id FROM games WHERE season = 1998)")
def delete_dry_run(spark, sf):
    g = B.games(spark, sf)
    return K.deletions({"games": g, "batting": B.batting(spark, sf)}, g.where("season = 1998"))


@query("wide_appearances", """SELECT game_id, player_id, b.PA, p.BF FROM (SELECT game_id, player_id, CAST(sum(PA) AS BIGINT) AS PA FROM batting GROUP BY ALL) b FULL OUTER JOIN (SELECT game_id, player_id, CAST(sum(BF) AS BIGINT) AS BF FROM pitching GROUP BY ALL) p USING (game_id, player_id)""")
def wide_appearances(spark, sf):
    keys = ["game_id", "player_id"]
    b, p = B.dealt(spark, sf, keys, B.batting(spark, sf), B.pitching(spark, sf))
    b, p = b.groupBy(*keys).agg(F.sum("PA").alias("PA")), p.groupBy(*keys).agg(F.sum("BF").alias("BF"))
    return K.wide_appearances(b, p).withColumnRenamed("pitching_BF", "BF")


@query("url_game_id", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'NYA20' || lpad(CAST(page_id % 1000000 AS VARCHAR), 6, '0') || '0' ELSE 'unknown' END AS game_id FROM pages", False)
def url_game_id(spark, sf):
    """A third of the addresses lead to a box score; others lack the folder, or the number's digits."""
    number = F.lpad((F.col("page_id") % 1000000).cast("string"), 6, "0")
    tail = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/boxes/NYA/NYA20"), number, F.lit("0.shtml"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/box/NYA20"), number, F.lit("0.shtml"))).otherwise("/boxes/NYA/NYA2024.shtml")
    return table(spark, sf, "pages").select("page_id", T.game_id(F.concat(F.coalesce("url", F.lit("https://x.test")), tail)).alias("game_id"))


_MARKED = ("/Boxes/x", "/2024-schedule", "/ROSTER/a", "/play_by_play", "/x.pbp", "/players/a", "/else")


def _addressed(spark, sf):
    """pages with one address each, of every category in turn."""
    tail = F.get(F.array(*map(F.lit, _MARKED)), (F.col("page_id") % len(_MARKED)).cast("int"))
    return table(spark, sf, "pages").withColumn("url", F.concat(F.lit("https://x.test/p"), "page_id", tail))


_CATEGORY = "CASE page_id % 7 WHEN 0 THEN 'box_scores' WHEN 1 THEN 'schedules' WHEN 2 THEN 'rosters' WHEN 3 THEN 'play_by_play' WHEN 4 THEN 'play_by_play' WHEN 5 THEN 'player_pages' ELSE 'general' END"


@query("url_category", f"SELECT {_CATEGORY} AS category, count(*) AS pages FROM pages GROUP BY 1", False)
def url_category(spark, sf):
    return _addressed(spark, sf).groupBy(C.category("url").alias("category")).agg(F.count("*").alias("pages"))


@query("ttl_refresh", f"""SELECT page_id FROM (SELECT page_id, {_CATEGORY} AS category, (page_id * 37) % 1000 AS age FROM pages)
    WHERE NOT age < CASE category WHEN 'box_scores' THEN 720 WHEN 'schedules' THEN 24 WHEN 'rosters' THEN 168 WHEN 'play_by_play' THEN 720 WHEN 'player_pages' THEN 720 ELSE 12 END""", False)
def ttl_refresh(spark, sf):
    """Pages of all categories and of ages up to 999 hours; an older copy of each page changes nothing."""
    at = F.expr("timestamp '2024-06-01 00:00:00' - make_interval(0, 0, 0, 0, CAST((page_id * 37) % 1000 AS INT), 0, 0)")
    pages = _addressed(spark, sf).select("url", "page_id", at.alias("fetched_at"), C.category("url").alias("category"))
    older = pages.withColumn("fetched_at", F.col("fetched_at") - F.expr("INTERVAL 900 HOURS"))
    return C.to_fetch(pages.select("url", "page_id"), pages.unionByName(older).drop("page_id"), F.lit("2024-06-01 00:00:00").cast("timestamp")).select("page_id")


@query("cache_stats", "SELECT 'general' AS category, count(*) AS pages, CAST(sum(strlen(html)) AS BIGINT) AS bytes FROM pages", False)
def cache_stats(spark, sf):
    return C.stats(table(spark, sf, "pages").withColumn("category", C.category("url")))


@query("text_rule_classify", """SELECT seq, CASE event_type WHEN 'view' THEN 'strikeout' WHEN 'signup' THEN 'walk' WHEN 'error' THEN 'error' WHEN 'click' THEN 'running' ELSE hit_type END AS rule, is_pa AS is_plate_appearance, is_ab AS is_at_bat, is_hit, is_walk, is_so AS is_strikeout, hit_type,
    CASE hit_type WHEN 'home_run' THEN 4 WHEN 'single' THEN 1 ELSE 0 END AS bases_reached FROM plays""")
def text_rule_classify(spark, sf):
    return P.classify(B.raw_plays(spark, sf)).select("seq", "rule", "is_plate_appearance", "is_at_bat", "is_hit", "is_walk", "is_strikeout", "hit_type", "bases_reached")


#: Descriptions and the rule each one has to come out with: every rule, and the order of those that overlap.
_SAID = (
    ("Caught Stealing 2B, interference by runner", "runner_interference"), ("Interference by Runner", "runner_interference"), ("Flyball: CF/Sacrifice Fly; Ann Lee Scores", "sacrifice_fly"), ("Sac Fly: LF", "sacrifice_fly"),
    ("Bunt Groundout: P-1B/Sacrifice Bunt", "sacrifice_hit"), ("Walk", "walk"), ("Intentional Walk", "walk"), ("Walk, Wild Pitch", "walk"), ("Hit By Pitch", "hit_by_pitch"), ("Strikeout Swinging Wild Pitch; Ann Lee to 1B", "strikeout_reached"),
    ("Double Play: Strikeout Looking", "strikeout_double_play"), ("Caught Stealing (PO) 2B (C-2B)", "running"), ("Wild Pitch; Lee to 2B", "running"), ("Passed Ball", "running"), ("Balk; Diaz to 3B", "running"), ("Lee Picked off 1B", "running"),
    ("Reached on E6 (Ground Ball)", "error"), ("Reached on Interference on C", "interference"), ("Strikeout Swinging", "strikeout"), ("Struck Out", "strikeout"), ("Strikeout Looking, Lee Caught Stealing 2B", "strikeout"),
    ("Ground Ball Double Play: SS-2B-1B", "double_play"), ("GDP ", "double_play"), ("Interference by Batter", "batter_interference"), ("Groundout: SS-1B", "out"), ("Flyball: RF; Lee to 3B", "out"), ("Fielder's Choice SS", "out"), ("Popfly: 2B", "out"),
    ("Home Run (Fly Ball)", "home_run"), ("Single to CF (Line Drive)", "single"), ("Single up the middle", "single"), ("Double to LF", "double"), ("Ground-rule Double", "double"), ("Triple to RF (Fly Ball)", "triple"), ("Mound Visit", None), ("", None),
)


@query("all_rules", f"SELECT seq, [{', '.join('NULL' if r is None else repr(r) for _, r in _SAID)}][CAST(seq % {len(_SAID)} AS INT) + 1] AS rule FROM plays")
def all_rules(spark, sf):
    """All rules in order, over descriptions whose rules are written down beside them."""
    said = F.get(F.array(*(F.lit(t) for t, _ in _SAID)), (F.col("seq") % len(_SAID)).cast("int"))
    return P.with_rule(B.raw_plays(spark, sf).withColumn("description", said)).select("seq", "rule")


@query("details_extract", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS n FROM events""", False)
def details_extract(spark, sf):
    k = F.regexp_extract("props", r"(\d+)", 1)
    details = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("SB,"), k, F.lit("·HR"))).when(F.col("event_id") % 3 == 1, "2B,HR,SB").otherwise("SB")
    return table(spark, sf, "events").select("event_id", T.detail_count(details, "HR").alias("n"))


@query("name_normalise", "SELECT player_id, translate(player_name, '#0123456789', ' abcdefghij') || CASE player_id % 4 WHEN 0 THEN ' Jr.' WHEN 3 THEN ' II' ELSE '' END AS name FROM players")
def name_normalise(spark, sf):
    """Codes, decisions and odd blanks go, suffixes stay."""
    tail = F.get(F.array(*map(F.lit, (" Jr. SS", ", W (1-0)", "   PH-LF", "\u00a0 II"))), (F.col("player_id") % 4).cast("int"))
    return B.players(spark, sf).select("player_id", T.normal_name(F.concat(F.translate("player_name", "#0123456789", " abcdefghij"), tail)).alias("name"))


@query("extract_all_codes", "SELECT doc_id, unnest(CASE doc_id % 3 WHEN 0 THEN ['W'] ELSE ['BS', 'L'] END) AS code FROM documents WHERE doc_id % 3 < 2", False)
def extract_all_codes(spark, sf):
    """All decisions of a pitcher's entry: one, two, or none."""
    tail = F.get(F.array(*map(F.lit, (", W (1-0)", ", BS (2), L (0-1)", " (x)"))), (F.col("doc_id") % 3).cast("int"))
    return table(spark, sf, "documents").select("doc_id", F.explode(T.decisions(F.concat(F.lit("Sal Kim"), tail))).alias("code"))


@query("eligible_batters", f"""{_ROWS} SELECT 'idle' AS without, game_id, team, row_idx FROM b WHERE NOT (code = 'P' AND PA = 0 AND AB = 0) AND flag <> 'N'
    UNION ALL SELECT 'all', game_id, team, row_idx FROM b WHERE code <> 'P' AND flag <> 'N'""")
def eligible_batters(spark, sf):
    """Rows that count as batters, by both rules for pitchers; those of one flag stand for totals."""
    rows = _rows(spark, sf).withColumn("player_name", F.when(F.col("flag") == "N", "Team Totals").otherwise(F.col("player_name")))
    one = lambda name, df: df.select(F.lit(name).alias("without"), "game_id", "team", "row_idx")
    return one("idle", L.eligible_batters(rows)).unionByName(one("all", L.eligible_batters(rows, all_pitchers=True)))


@query("season_dates", """, d AS (SELECT CAST(d AS DATE) AS day FROM unnest(generate_series(TIMESTAMP '1997-03-01', TIMESTAMP '1997-11-30', INTERVAL 1 DAY)) AS u(d))
    SELECT CAST(day AS VARCHAR) AS day, count(game_id) AS games FROM d LEFT JOIN games ON game_date = day GROUP BY day""")
def season_dates(spark, sf):
    """A season's days and how many games each has."""
    played = B.games(spark, sf).groupBy(F.col("game_date").alias("day")).agg(F.count("*").alias("games"))
    return D.season_days(spark, 1997).join(played, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("games", F.lit(0)).alias("games"))


@query("edge_games", ", n AS (SELECT game_id, home_team, row_number() OVER (PARTITION BY home_team ORDER BY game_date DESC, game_id DESC) AS k FROM games) SELECT game_id, home_team FROM n WHERE k <= 3")
def edge_games(spark, sf):
    return D.edge_games(B.games(spark, sf), 3, last=True, team="home_team").select("game_id", "home_team")


@query("exists_probe", "SELECT game_id, game_id IN (SELECT game_id FROM batting) AS is_stored FROM games")
def exists_probe(spark, sf):
    return ST.known_games(B.games(spark, sf).select("game_id"), B.batting(spark, sf))


@query("delete_season", "SELECT 'games' AS table_name, count(*) AS n FROM games WHERE season <> 1997 UNION ALL SELECT 'batting', count(*) FROM batting WHERE game_id IN (SELECT game_id FROM games WHERE season <> 1997)")
def delete_season(spark, sf):
    g = B.games(spark, sf)
    kept = K.delete_season({"games": g, "batting": B.batting(spark, sf)}, g, 1997)
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n, df in kept.items()))


@query("meaningful_rows", "SELECT game_id, player_id, row_idx FROM batting WHERE H + R + HR > 0")
def meaningful_rows(spark, sf):
    return Q.meaningful(B.batting(spark, sf), ("H", "R", "HR", "none")).select("game_id", "player_id", "row_idx")


@query("name_strategy", """, o AS (SELECT DISTINCT game_id, 'B' || player_id AS name FROM batting), s AS (SELECT DISTINCT game_id, 'raw' AS strategy, batter_name AS name FROM plays UNION SELECT DISTINCT game_id, 'digits', replace(batter_name, 'B', '') FROM plays)
    SELECT strategy, count(*) AS matches FROM s JOIN o USING (game_id, name) GROUP BY strategy""")
def name_strategy(spark, sf):
    official = B.batting(spark, sf).select("game_id", F.concat(F.lit("B"), "player_id").alias("player_name"))
    return N.best_strategy(official, B.raw_plays(spark, sf), {"raw": F.col("batter_name"), "digits": F.replace("batter_name", F.lit("B"), F.lit(""))})


@query("discrepancy_table", f"{_DIFFS} SELECT game_id, player_id, max(diff) FILTER (WHERE stat = 'PA') AS PA, max(diff) FILTER (WHERE stat = 'SO') AS SO FROM x WHERE diff <> 0 GROUP BY ALL")
def discrepancy_table(spark, sf):
    return RP.discrepancy_table(_diffs(spark, sf), ["game_id", "player_id"], ("PA", "SO"))


@query("reprocessing_summary", f""", p AS ({_PIVOT}), l AS (SELECT * FROM p WHERE batting_accuracy < 90 OR pitching_accuracy < 90)
    SELECT count(*) AS games, CAST(min(game_date) AS VARCHAR) AS first_date, CAST(max(game_date) AS VARCHAR) AS last_date, min(batting_accuracy) AS low_batting_accuracy, max(batting_accuracy) AS high_batting_accuracy, round(avg(batting_accuracy), 6) AS mean_batting_accuracy,
    min(pitching_accuracy) AS low_pitching_accuracy, max(pitching_accuracy) AS high_pitching_accuracy, round(avg(pitching_accuracy), 6) AS mean_pitching_accuracy FROM l""")
def reprocessing_summary(spark, sf):
    out = RP.reprocessing(B.reports(spark, sf), B.games(spark, sf), 90, "https://x.test")["summary"]
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")} | {c: F.round(c, 6) for c in ("mean_batting_accuracy", "mean_pitching_accuracy")})


@query("play_flags", """SELECT seq, hit_type, CASE WHEN event_type = 'view' THEN 'strikeout_swinging' END AS out_type, is_pa AS is_plate_appearance, is_walk, is_so AS is_strikeout, CASE WHEN hit_type = 'home_run' THEN 1 ELSE 0 END AS rbi FROM plays""")
def play_flags(spark, sf):
    return P.flags(B.raw_plays(spark, sf)).select("seq", "hit_type", "out_type", "is_plate_appearance", "is_walk", "is_strikeout", "rbi")


@query("conservative_classify", "SELECT seq, CASE event_type WHEN 'view' THEN 'strikeout' WHEN 'signup' THEN 'walk' ELSE hit_type END AS rule, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 0 WHEN 'purchase' THEN CASE hit_type WHEN 'home_run' THEN 4 ELSE 1 END END AS bases_reached FROM plays")
def conservative_classify(spark, sf):
    return P.classify(B.raw_plays(spark, sf), rules=P.CONSERVATIVE_RULES, outcomes=P.CONSERVATIVE_OUTCOMES).select("seq", "rule", "bases_reached")


@query("season_window_counts", "SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY ALL", False)
def season_window_counts(spark, sf):
    counted = table(spark, sf, "events").groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("day"), "event_type", "n")


@query("html_cells", """WITH p AS (SELECT url, page_id FROM pages)
    SELECT url, 'play_by_play' AS table_id, 0 AS table_idx, 0 AS row_idx, 0 AS col_idx, TRUE AS is_head, 'Inn' AS text, NULL AS href, NULL AS stat, FALSE AS is_indented FROM p
    UNION ALL SELECT url, 'play_by_play', 0, 0, 1, TRUE, 'Batter & more', NULL, NULL, FALSE FROM p
    UNION ALL SELECT url, 'play_by_play', 0, 1, 0, FALSE, 't' || page_id, NULL, 'inning', FALSE FROM p
    UNION ALL SELECT url, 'play_by_play', 0, 1, 1, FALSE, 'B ' || page_id, '/players/b/' || page_id, NULL, TRUE FROM p
    UNION ALL SELECT url, 'AAAbatting', 0, 0, 0, FALSE, 'in a comment', NULL, NULL, TRUE FROM p
    UNION ALL SELECT url, 'BBBbatting', 1, 0, 0, TRUE, '', NULL, NULL, FALSE FROM p""", False)
def html_cells(spark, sf):
    """Tables before each page's own text: headings, links, marks of indentation, one in a comment, two of a kind, one unclosed."""
    n = F.col("page_id").cast("string")
    made = F.concat(
        F.lit("<table id='play_by_play'><tr><th>Inn</th><th>Batter &amp; more</th></tr><tr><td data-stat='inning'>t"), n, F.lit("</td><td>&nbsp;<a href='/players/b/"), n, F.lit("'>B "), n,
        F.lit("</a></td></tr></table><!-- <table id='AAAbatting'><tr><td style='padding-left:1em'>in a comment</table> --><table id='BBBbatting'><tr><th></table>"),
    )
    return HP.cells(table(spark, sf, "pages").select("url", F.concat(made, F.coalesce("html", F.lit(""))).alias("html")))


@query("catalog_overview", "SELECT 'games' AS table_name, count(*) AS n_rows, 9 AS n_columns FROM games UNION ALL SELECT 'players', count(*), 4 FROM players")
def catalog_overview(spark, sf):
    return X.overview({"games": B.games(spark, sf), "players": B.players(spark, sf)})


@query("sql_passthrough", "SELECT venue, count(*) AS n FROM games GROUP BY venue")
def sql_passthrough(spark, sf):
    name = f"games_{uuid.uuid4().hex}"
    X.register({name: B.games(spark, sf)})
    out = X.sql(spark, f"SELECT venue, count(*) AS n FROM {name} GROUP BY venue")
    spark.catalog.dropTempView(name)  # the plan is made; no view stays in the session
    return out


_BEFORE = ", ".join(f"CAST(sum({c}) OVER (PARTITION BY player_id ORDER BY game_date, game_id ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) AS BIGINT) AS L{k}_{c}" for k in (5, 10, 15) for c in ("PA", "AB", "H", "HR"))
_FORM_SQL = f""", fd AS (SELECT player_id, game_id, game_date, sum(PA) AS PA, sum(AB) AS AB, sum(H) AS H, sum(HR) AS HR FROM batting JOIN games USING (game_id) GROUP BY ALL),
    fw AS (SELECT player_id, game_id, {_BEFORE} FROM fd), form AS (SELECT *, {", ".join(f"{_rate(f'L{k}_H', f'L{k}_AB')} AS L{k}_AVG" for k in (5, 10, 15))} FROM fw)"""


@query("form_before", f"{_FORM_SQL} SELECT * FROM form")
def form_before(spark, sf):
    return S.form_before(*B.dealt(spark, sf, ["game_id"], B.batting(spark, sf), B.games(spark, sf)), parts=B.parts(spark, sf))


@query("game_context", f"""{_FORM_SQL}, st AS (SELECT game_id, team, arg_min(player_id, pitching_order * 1000 + player_id) AS pitcher_id FROM pitching WHERE is_starter GROUP BY ALL),
    ot AS (SELECT game_id, CASE team WHEN 'home' THEN 'away' ELSE 'home' END AS team, pitcher_id, throws, CASE throws WHEN 'R' THEN 'RHP' WHEN 'L' THEN 'LHP' END AS against FROM st LEFT JOIN players ON player_id = pitcher_id),
    sl AS (SELECT player_id, season, CAST(sum(H) AS BIGINT) AS H FROM batting JOIN games USING (game_id) WHERE NOT is_playoff GROUP BY ALL), vl AS (SELECT player_id, venue, CAST(sum(H) AS BIGINT) AS H FROM batting JOIN games USING (game_id) GROUP BY ALL),
    ll AS (SELECT player_id, season, team, CAST(sum(H) AS BIGINT) AS H FROM batting JOIN games USING (game_id) GROUP BY ALL), ml AS (SELECT batter_id, pitcher_id, count(*) FILTER (WHERE is_hit) AS H FROM plays GROUP BY ALL),
    hl AS (SELECT batter_id, season, CASE a.throws WHEN 'R' THEN 'RHP' ELSE 'LHP' END AS against, count(*) FILTER (WHERE is_hit) AS H FROM plays p JOIN games USING (game_id) JOIN players a ON a.player_id = p.pitcher_id WHERE a.throws IS NOT NULL GROUP BY ALL),
    b AS (SELECT DISTINCT game_id, player_id, team FROM batting)
    SELECT b.game_id, b.player_id, b.team, ot.pitcher_id, ot.throws, sl.H AS season_H, vl.H AS venue_H, ll.H AS location_H, ml.H AS matchup_H, hl.H AS arm_H, form.L5_H, form.L15_AVG, g.home_team, w.player_name
    FROM b JOIN games g USING (game_id) LEFT JOIN players w ON w.player_id = b.player_id LEFT JOIN ot ON ot.game_id = b.game_id AND ot.team = b.team LEFT JOIN form ON form.player_id = b.player_id AND form.game_id = b.game_id
    LEFT JOIN sl ON sl.player_id = b.player_id AND sl.season = g.season LEFT JOIN vl ON vl.player_id = b.player_id AND vl.venue = g.venue LEFT JOIN ll ON ll.player_id = b.player_id AND ll.season = g.season AND ll.team = b.team
    LEFT JOIN ml ON ml.batter_id = b.player_id AND ml.pitcher_id = ot.pitcher_id LEFT JOIN hl ON hl.batter_id = b.player_id AND hl.season = g.season AND hl.against = ot.against""")
def game_context(spark, sf):
    rows = S.game_context(B.batting(spark, sf), B.pitching(spark, sf), B.events(spark, sf), B.games(spark, sf), B.players(spark, sf), B.parts(spark, sf))
    return rows.selectExpr("game_id", "player_id", "team", "pitcher_id", "throws", "season_line.H AS season_H", "at_venue.H AS venue_H", "at_location.H AS location_H", "matchup.H AS matchup_H", "handedness.H AS arm_H", "form.L5_H", "form.L15_AVG", "game_info.home_team", "player_info.player_name")


@query("busiest_pitchers", "SELECT game_id, player_id, pitching_order, BF FROM pitching ORDER BY BF DESC, game_id, player_id, pitching_order LIMIT 20")
def busiest_pitchers(spark, sf):
    return S.busiest_pitchers(B.pitching(spark, sf))


@query("two_way_by_pa", "SELECT game_id, player_id, PA, BF FROM (SELECT game_id, player_id, CAST(sum(PA) AS BIGINT) AS PA FROM batting GROUP BY ALL) JOIN (SELECT game_id, player_id, CAST(sum(BF) AS BIGINT) AS BF FROM pitching GROUP BY ALL) USING (game_id, player_id) ORDER BY PA DESC, game_id, player_id LIMIT 20")
def two_way_by_pa(spark, sf):
    return S.two_way_by_plate_appearances(*B.dealt(spark, sf, ["game_id", "player_id"], B.batting(spark, sf), B.pitching(spark, sf)))


@query("first_events", "SELECT seq, event_order FROM (SELECT seq, row_number() OVER (PARTITION BY game_id ORDER BY inning, CASE inning_half WHEN 'top' THEN 0 ELSE 1 END, seq) AS event_order FROM plays) WHERE event_order <= 10")
def first_events(spark, sf):
    return E.first_events(E.renumber(B.events(spark, sf))).select("seq", "event_order")


@query("event_totals", """SELECT game_id, count(*) AS events, count(*) FILTER (WHERE is_pa) AS plate_appearances, count(*) FILTER (WHERE is_ab) AS at_bats, count(*) FILTER (WHERE is_hit) AS hits, count(*) FILTER (WHERE is_walk) AS walks, count(*) FILTER (WHERE is_so) AS strikeouts,
    count(*) FILTER (WHERE is_so) AS outs, CAST(0 AS BIGINT) AS doubles, CAST(0 AS BIGINT) AS triples, count(*) FILTER (WHERE hit_type = 'home_run') AS home_runs FROM plays GROUP BY game_id""")
def event_totals(spark, sf):
    return E.event_totals(B.events(spark, sf))


@query("half_innings", "SELECT seq FROM plays WHERE seq % 5 < 2")
def half_innings(spark, sf):
    code = F.get(F.array(*map(F.lit, ("t1", "b12", "Top of the 1st", "T1", "t"))), (F.col("seq") % 5).cast("int"))
    return E.half_innings(B.raw_plays(spark, sf).withColumn("inn", code)).select("seq")


@query("batter_lines", """SELECT game_id, inning_half AS side, batter_name AS player_name, count(*) FILTER (WHERE is_pa) AS PA, count(*) FILTER (WHERE is_ab) AS AB, count(*) FILTER (WHERE is_hit) AS H, count(*) FILTER (WHERE is_walk) AS BB, count(*) FILTER (WHERE is_so) AS SO,
    count(*) FILTER (WHERE hit_type = 'home_run') AS HR, CAST(0 AS BIGINT) AS doubles, CAST(0 AS BIGINT) AS triples FROM plays GROUP BY ALL""")
def batter_lines(spark, sf):
    return R.batter_lines(B.events(spark, sf).withColumnRenamed("inning_half", "side"), ("game_id", "side"))


@query("pitcher_lines", """SELECT game_id, pitcher_name AS player_name, count(*) FILTER (WHERE is_pa) AS BF, count(*) FILTER (WHERE is_hit) AS H, count(*) FILTER (WHERE is_walk) AS BB, count(*) FILTER (WHERE is_so) AS SO,
    count(*) FILTER (WHERE hit_type = 'home_run') AS HR, CAST(sum(pitch_count) AS BIGINT) AS PC, count(*) FILTER (WHERE is_so) AS outs FROM plays GROUP BY ALL""")
def pitcher_lines(spark, sf):
    return R.pitcher_lines(B.events(spark, sf))


@query("runner_events", """SELECT seq, kind, batter_name AS runner, from_base, to_base FROM plays JOIN (VALUES (0, 'steal', '1st', '2nd'), (1, 'caught', '2nd', '3b'), (2, 'run', NULL, NULL), (2, 'steal', '3rd', 'home')) AS m(k, kind, from_base, to_base) ON seq % 4 = k""")
def runner_events(spark, sf):
    """Steals, caught steals and runs named in descriptions, two of them in one."""
    who = F.col("batter_name")
    said = F.when(F.col("seq") % 4 == 0, F.concat(who, F.lit(" Steals 2nd"))).when(F.col("seq") % 4 == 1, F.concat(who, F.lit(" Caught Stealing 3B (C-3B)"))).when(F.col("seq") % 4 == 2, F.concat(who, F.lit(" Scores; "), who, F.lit(" Steals home"))).otherwise("Walk")
    return E.runner_events(B.raw_plays(spark, sf).withColumn("description", said)).select("seq", "kind", "runner", "from_base", "to_base")


@query("alias_resolution", """, k AS (SELECT DISTINCT game_id, player_id FROM batting), a AS (SELECT DISTINCT game_id, player_id FROM batting WHERE player_id % 3 < 2)
    SELECT a.game_id, CASE a.player_id % 3 WHEN 0 THEN 'A. Player' || a.player_id ELSE 'ann player' || a.player_id END AS who, a.player_id AS id FROM a""")
def alias_resolution(spark, sf):
    """Initials and other cases find the player of the game."""
    (lines,) = B.dealt(spark, sf, ["game_id"], B.batting(spark, sf))
    known = lines.select("game_id", "player_id", F.concat(F.lit("Ann Player"), "player_id").alias("player_name")).distinct()
    asked = known.where("player_id % 3 < 2").select("game_id", F.when(F.col("player_id") % 3 == 0, F.concat(F.lit("A. Player"), "player_id")).otherwise(F.concat(F.lit("ann player"), "player_id")).alias("who"))
    return N.resolve(asked, known, "who", "id", B.parts(spark, sf))


@query("drill_down", f"{_DIFFS}, t AS (SELECT game_id, player_id, count(*) AS n FROM x WHERE diff <> 0 GROUP BY ALL), e AS (SELECT game_id, batter_id AS player_id, count(*) AS plays FROM plays GROUP BY ALL) SELECT game_id, 'B' || player_id AS player_name, t.n AS texts, coalesce(e.plays, 0) AS plays FROM t LEFT JOIN e USING (game_id, player_id)")
def drill_down(spark, sf):
    diffs = _diffs(spark, sf).where("diff <> 0").withColumn("player_name", F.concat(F.lit("B"), "player_id"))
    (diffs,), (plays,) = B.dealt(spark, sf, ["game_id", "player_name"], diffs), B.dealt(spark, sf, ["game_id"], B.events(spark, sf))
    rows = R.drill_down(diffs, E.renumber(plays))
    return rows.select("game_id", "player_name", F.size("texts").cast("long").alias("texts"), F.coalesce(F.size("plays"), F.lit(0)).cast("long").alias("plays"))


@query("indented_order", f"""{_ROWS}, n AS (SELECT *, coalesce(sum(CASE WHEN sub THEN 0 ELSE 1 END) OVER (PARTITION BY game_id, team ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM b)
    SELECT game_id, team, row_idx, CAST(least(2, CASE WHEN NOT sub THEN k + 1 WHEN PA > 0 THEN greatest(1, k) END) AS BIGINT) AS batting_order, CASE WHEN code = 'PR' THEN 'pinch_runner' WHEN code = 'PH' THEN 'pinch_hitter' WHEN sub THEN 'defensive' END AS substitution FROM n""")
def indented_order(spark, sf):
    return L.indented_order(_rows(spark, sf), most=2).select("game_id", "team", "row_idx", F.col("batting_order").cast("long").alias("batting_order"), "substitution")


@query("discrepancy_spread", f"{_DIFFS}, spread AS (SELECT game_id, player_id, count(*) AS n FROM x WHERE diff <> 0 GROUP BY ALL) SELECT CASE n WHEN 1 THEN 'single' ELSE 'multiple' END AS kind, count(*) AS players FROM spread GROUP BY 1")
def discrepancy_spread(spark, sf):
    return R.discrepancy_spread(_diffs(spark, sf), ["game_id", "player_id"]).select("kind", "players")


@query("player_bios", """SELECT 'x' || lpad(CAST(page_id % 1000 AS VARCHAR), 4, '0') AS player_id, 'Ann Lee' AS full_name, CASE page_id % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'L' ELSE 'S' END AS bats, 'L' AS throws, '1990-02-03' AS birth_date, '2014-04-01' AS debut_date, 74 AS height_inches, 200 AS weight_lbs FROM pages""", False)
def player_bios(spark, sf):
    number = F.lpad((F.col("page_id") % 1000).cast("string"), 4, "0")
    hand = F.get(F.array(*map(F.lit, ("Right", "Left", "Both"))), (F.col("page_id") % 3).cast("int"))
    html = F.concat(F.lit("<h1><span>Ann Lee</span></h1><p><strong>Bats: </strong>"), hand, F.lit(" <strong>Throws: </strong>Left</p><p>6-2, 200lb</p><span id='necro-birth' data-birth=\"1990-02-03\">Born: January 1, 1980</span><p>Debut: April 1, 2014</p>"))
    pages = table(spark, sf, "pages").select(F.concat(F.lit("https://x.test/players/x/x"), number, F.lit(".shtml")).alias("url"), html.alias("html"))
    return HP.bios(HP.rows(pages)).withColumns({c: F.col(c).cast("string") for c in ("birth_date", "debut_date")})


#: Two batches of the given tables: games are replaced by later ones, lines stay as they came first.
_BATCHES = {
    "games": V.Keyed(("game_id",), "game_id % 7", "new", owner="game_id"),
    "lines": V.Keyed(("game_id", "player_id", "row_idx"), "game_id % 7", "old", (("games", "game_id"),), "game_id"),
}


def _stored(spark, sf, name):
    """A store of two batches: games up to 1998 with the lines of row 1, then games from 1998 with another venue and the lines of rows 1 and 2."""
    games, lines = B.games(spark, sf).select("game_id", "season", "venue"), B.batting(spark, sf).groupBy("game_id", "player_id", "row_idx").agg(F.sum("H").alias("H"))
    store = V.Store(spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", _BATCHES)
    of = lambda g, most, more: {"games": g, "lines": lines.where(F.col("row_idx") <= most).withColumn("H", F.col("H") + more).join(g.select("game_id"), "game_id", "left_semi")}
    first, second = of(games.where("season <= 1998"), 1, 0), of(games.where("season >= 1998").withColumn("venue", F.concat("venue", F.lit("!"))), 2, 1000)
    store.merge(first, ("trial", 0))
    store.merge(second, ("trial", 1))
    store.merge(first, ("trial", 0))  # comes again, as after a failure, and changes nothing
    return store


_STORED_SQL = """, sg AS (SELECT game_id, season, CASE WHEN season >= 1998 THEN venue || '!' ELSE venue END AS venue FROM games),
    ll AS (SELECT game_id, player_id, row_idx, CAST(sum(H) AS BIGINT) AS H FROM batting GROUP BY ALL),
    sl AS (SELECT game_id, player_id, row_idx, CASE WHEN row_idx = 1 AND season <= 1998 THEN H ELSE H + 1000 END AS H FROM ll JOIN games USING (game_id) WHERE row_idx = 1 OR row_idx = 2 AND season >= 1998)"""


@query("store_two_batches", f"""{_STORED_SQL} SELECT sg.game_id, sg.venue, count(sl.player_id) AS n_lines, CAST(coalesce(sum(sl.H), 0) AS BIGINT) AS H FROM sg LEFT JOIN sl USING (game_id) GROUP BY ALL""")
def store_two_batches(spark, sf):
    """What a store holds after two batches and a replay."""
    store = _stored(spark, sf, "store-two-batches")
    lines = store.read("lines").groupBy("game_id").agg(F.count("*").alias("n_lines"), F.sum("H").alias("H"))
    return store.read("games").join(lines, "game_id", "left").select("game_id", "venue", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("H", F.lit(0)).cast("long").alias("H"))


@query("store_deletes", f"""{_STORED_SQL} SELECT 'games' AS table_name, game_id % 7 AS part, count(*) AS n FROM sg WHERE season <> 1996 AND game_id % 7 <> 3 GROUP BY ALL
    UNION ALL SELECT 'lines', game_id % 7, count(*) FROM sl JOIN sg USING (game_id) WHERE season <> 1996 AND game_id % 7 <> 3 GROUP BY ALL""")
def store_deletes(spark, sf):
    """The rows that stay after a season's games are hidden and a partition has left the manifest."""
    store = _stored(spark, sf, "store-deletes")
    store.delete(B.games(spark, sf).where("season = 1996").select("game_id"))
    store.delete_partition("3")
    one = lambda name: store.read(name).groupBy((F.col("game_id") % 7).alias("part")).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "part", "n")
    return one("games").unionByName(one("lines"))


_MENU = "<nav><a href='/teams/NYY/2024'>x</a><a href='/teams/BOS/2024'>y</a><div class='score'>99</div><strong>Venue</strong>: Menu</nav>"


def _boxed(spark, sf):
    """Each page's own HTML behind a score box of its number, menus and boxes of other games around it; quotes, nesting and breaks vary."""
    n, d = F.col("page_id").cast("string"), F.col("page_id")
    code = F.concat(F.lit("T"), F.chr(65 + d % 26), F.chr(65 + (d + 7) % 26))
    first = F.when(d % 3 == 0, F.concat(F.lit("<div class='scorebox'><div><strong><a href='/teams/"), code, F.lit("/2024.shtml'>A</a></strong><div class='score'>"), (d % 10).cast("string"), F.lit("</div></div>")))
    first = first.when(d % 3 == 1, F.concat(F.lit('<div id=x class="wide scorebox"><div><span><a class=t href="/teams/'), code, F.lit('/2024.shtml">A</a></span><div class="big score"> '), (d % 10).cast("string"), F.lit("<br></div></div>")))
    first = first.otherwise(F.concat(F.lit("<DIV CLASS=scorebox><div><a href=/teams/"), code, F.lit("/>A</a><div class=score><b>"), (d % 10).cast("string"), F.lit("</b></div></div>")))
    rest = F.concat(
        F.lit("<div><a href='/teams/HOM/2024.shtml'>B</a><div class='score'>"), (d % 7).cast("string"), F.lit("</div></div><div class='scorebox_meta'><div>Monday, April "), (d % 28 + 1).cast("string"),
        F.lit(", 2024</div><div>Start Time: 7:05 p.m. Local</div><div>Attendance: 1</div><div><strong>Venue</strong>: Park "), n, F.lit("</div></div></div><div class='scorebox'><a href='/teams/ZZZ/1'>z</a><div class='score'>98</div></div>"),
        F.lit("<table class='x linescore'><thead><tr><th rowspan=2></th><th colspan=9>Innings</th></tr><tr><th>1</th><th>9</th><th>"), F.when(d % 5 == 0, "12").otherwise("R"), F.lit("</th></tr></thead></table>"),
    )
    html = F.concat(F.lit(f"<html><head><title>A at B</title></head><body>{_MENU}"), first, rest, F.coalesce("html", F.lit("")), F.lit("</body></html>"))
    return table(spark, sf, "pages").select(F.concat(F.lit("https://x.test/boxes/HOM/HOM2024"), F.lpad(n, 5, "0"), F.lit(".shtml")).alias("url"), html.alias("html"))


@query("page_facts", """SELECT 'HOM2024' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS game_id, '2024-04-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS game_date, '7:05 PM' AS game_time, 'HOM' AS home_team,
    'T' || chr(CAST(65 + page_id % 26 AS INT)) || chr(CAST(65 + (page_id + 7) % 26 AS INT)) AS away_team, CAST(page_id % 7 AS INT) AS runs_home_team, CAST(page_id % 10 AS INT) AS runs_away_team, 'Park ' || page_id AS venue, CASE WHEN page_id % 5 = 0 THEN 12 ELSE 9 END AS innings_played,
    CASE WHEN page_id % 7 > page_id % 10 THEN 'HOM' WHEN page_id % 7 < page_id % 10 THEN 'T' || chr(CAST(65 + page_id % 26 AS INT)) || chr(CAST(65 + (page_id + 7) % 26 AS INT)) END AS winner FROM pages""", False)
def page_facts(spark, sf):
    """Facts from the score box of each page, whatever its menus and other boxes say."""
    names = ("game_id", "game_date", "game_time", "home_team", "away_team", "runs_home_team", "runs_away_team", "venue", "innings_played", "winner")
    return HP.games(HP.rows(_boxed(spark, sf))).select(*names).withColumn("game_date", F.col("game_date").cast("string"))


@query("html_grid", """WITH p AS (SELECT page_id, page_id % 3 + 1 AS w, page_id % 2 + 1 AS h FROM pages), r AS (SELECT page_id, w, h, i FROM p, unnest(range(1, 5)) AS u(i))
    SELECT page_id, i AS line, CASE WHEN i <= h THEN 'tall' ELSE 'n' || i END AS name, CASE WHEN i = 3 THEN 'wide' ELSE 'a' || i END AS ab, CASE WHEN i = 3 AND w >= 2 THEN 'wide' WHEN i = 3 THEN 'h3' ELSE 'h' || i END AS hits,
    CASE WHEN i = 3 AND w >= 3 THEN 'wide' WHEN i = 3 THEN 'r3' ELSE 'r' || i END AS runs FROM r""", False)
def html_grid(spark, sf):
    """Tables with headings over two rows, and cells that span one to three columns or one or two rows."""
    w, h = F.col("page_id") % 3 + 1, F.col("page_id") % 2 + 1
    spans = lambda name, n: F.concat(F.lit(f" {name}="), n.cast("string"))
    name = lambda i: F.when(F.lit(i) == 1, F.concat(F.lit("<td"), spans("rowspan", h), F.lit(">tall</td>"))).when((F.lit(i) == 2) & (h == 2), "").otherwise(f"<td>n{i}</td>")
    plain = lambda i: F.lit(f"<td>a{i}</td><td>h{i}</td><td>r{i}</td>")
    wide = F.concat(F.lit("<td"), spans("colspan", w), F.lit(">wide</td>"), F.when(w == 1, "<td>h3</td><td>r3</td>").when(w == 2, "<td>r3</td>").otherwise(""))
    lines = [F.concat(F.lit("<tr>"), name(i), wide if i == 3 else plain(i), F.lit("</tr>")) for i in range(1, 5)]
    head = F.lit("<table id='grid'><thead><tr><th rowspan='2'>Name</th><th colspan='3'>Batting</th></tr><tr><th>AB</th><th>H</th><th>R</th></tr></thead><tbody>")
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("url"), F.concat(head, *lines, F.lit("</tbody></table>"), F.coalesce("html", F.lit(""))).alias("html"))
    rows = HP.wide(HP.rows(pages).where("table_id = 'grid'"), {"Name": "name", "AB": "ab", "H": "hits", "R": "runs"})
    return rows.select(F.col("url").cast("long").alias("page_id"), (F.col("row_idx") - 1).cast("long").alias("line"), "name", "ab", "hits", "runs")


def _told(spark, sf):
    """The plays with texts of every kind of move; steals and caught steals name the batter before."""
    k, before = F.col("seq") % 10, F.coalesce(F.lag("batter_name").over(W.partitionBy("game_id").orderBy("seq")), F.lit("Nobody"))
    said = F.get(F.array(*map(F.lit, ("Walk", "", "Single to CF", "Strikeout Swinging", "Reached on E6", "", "Double to LF", "Groundout: SS-1B", "Walk", "Home Run (Fly Ball)"))), k.cast("int"))
    said = F.when(k == 1, F.concat(before, F.lit(" Steals 2B"))).when(k == 5, F.concat(before, F.lit(" Caught Stealing 2B (C-SS)"))).otherwise(said)
    return P.classify(B.raw_plays(spark, sf).withColumn("description", said))


_MOVED_SQL = B.SQL.replace("WITH games", "WITH RECURSIVE games", 1) + """, o AS (
      SELECT game_id, seq, batter_name AS who, lag(batter_name) OVER w AS before, row_number() OVER w AS k, seq % 10 AS kind, seq % 10 IN (0, 4, 8) AS free, CASE seq % 10 WHEN 2 THEN 1 WHEN 6 THEN 2 WHEN 9 THEN 4 ELSE 0 END AS reach
      FROM plays WINDOW w AS (PARTITION BY game_id ORDER BY seq)
    ), r AS (
      SELECT game_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS seq, CAST(0 AS BIGINT) AS kind, CAST('' AS VARCHAR) AS who, CAST(NULL AS VARCHAR) AS p1, CAST(NULL AS VARCHAR) AS p2, CAST(NULL AS VARCHAR) AS p3,
             CAST(NULL AS INT) AS t0, CAST(NULL AS INT) AS t1, CAST(NULL AS INT) AS t2, CAST(NULL AS INT) AS t3, CAST(NULL AS INT) AS named, CAST(NULL AS VARCHAR) AS a1, CAST(NULL AS VARCHAR) AS a2, CAST(NULL AS VARCHAR) AS a3, 0 AS outs
      FROM o GROUP BY game_id
      UNION ALL
      SELECT game_id, k, seq, kind, who, p1, p2, p3, t0, t1, t2, t3, named,
             CASE WHEN total >= 3 THEN NULL WHEN t0 = 1 THEN who WHEN t1 = 1 THEN p1 END, CASE WHEN total >= 3 THEN NULL WHEN t0 = 2 THEN who WHEN t1 = 2 THEN p1 WHEN t2 = 2 THEN p2 END,
             CASE WHEN total >= 3 THEN NULL WHEN t0 = 3 THEN who WHEN t1 = 3 THEN p1 WHEN t2 = 3 THEN p2 WHEN t3 = 3 THEN p3 END, CASE WHEN total >= 3 THEN 0 ELSE total END
      FROM (
        SELECT *, outs + (kind IN (3, 5, 7))::INT AS total,
               CASE WHEN named = 1 AND kind = 5 THEN NULL WHEN named = 1 THEN greatest(m1, 2) ELSE m1 END AS t1, CASE WHEN named = 2 AND kind = 5 THEN NULL ELSE m2 END AS t2, CASE WHEN named = 3 AND kind = 5 THEN NULL ELSE m3 END AS t3
        FROM (
          SELECT o.game_id, o.k, o.seq, o.kind, o.who, r.a1 AS p1, r.a2 AS p2, r.a3 AS p3, r.outs,
                 CASE WHEN o.free THEN 1 WHEN o.reach > 0 THEN o.reach END AS t0,
                 CASE WHEN r.a1 IS NULL THEN NULL WHEN o.free THEN 2 ELSE least(1 + o.reach, 4) END AS m1,
                 CASE WHEN r.a2 IS NULL THEN NULL WHEN o.free THEN CASE WHEN r.a1 IS NULL THEN 2 ELSE 3 END ELSE least(2 + o.reach, 4) END AS m2,
                 CASE WHEN r.a3 IS NULL THEN NULL WHEN o.free THEN CASE WHEN r.a1 IS NULL OR r.a2 IS NULL THEN 3 ELSE 4 END ELSE least(3 + o.reach, 4) END AS m3,
                 CASE WHEN o.kind NOT IN (1, 5) THEN NULL WHEN r.a1 = o.before THEN 1 WHEN r.a2 = o.before THEN 2 WHEN r.a3 = o.before THEN 3 END AS named
          FROM r JOIN o ON o.game_id = r.game_id AND o.k = r.k + 1
        )
      )
    ), moved AS (
      SELECT game_id, seq, who AS batter, who AS runner, 0 AS from_base, t0 AS to_base, t0 IS NULL AS is_out, 'bat' AS how, t0 = 4 AS batted_in FROM r WHERE k > 0 AND (t0 IS NOT NULL OR kind IN (3, 7))
      UNION ALL SELECT game_id, seq, who, p1, 1, t1, t1 IS NULL, CASE WHEN named = 1 THEN CASE kind WHEN 1 THEN 'steal' ELSE 'caught' END ELSE 'bat' END, t1 = 4 AND kind <> 4 FROM r WHERE k > 0 AND p1 IS NOT NULL AND t1 IS DISTINCT FROM 1
      UNION ALL SELECT game_id, seq, who, p2, 2, CASE WHEN t1 = 2 AND t2 = 2 THEN NULL ELSE t2 END, t2 IS NULL, CASE WHEN named = 2 AND kind = 5 THEN 'caught' ELSE 'bat' END, t2 = 4 AND kind <> 4 FROM r WHERE k > 0 AND p2 IS NOT NULL AND (t2 IS DISTINCT FROM 2 OR t1 = 2)
      UNION ALL SELECT game_id, seq, who, p3, 3, t3, t3 IS NULL, CASE WHEN named = 3 AND kind = 5 THEN 'caught' ELSE 'bat' END, t3 = 4 AND kind <> 4 FROM r WHERE k > 0 AND p3 IS NOT NULL AND t3 IS DISTINCT FROM 3
    )"""


@query("base_transitions", f"{_MOVED_SQL} SELECT game_id, seq, batter, runner, from_base, to_base, is_out, how, coalesce(batted_in, FALSE) AS batted_in FROM moved", False)
def base_transitions(spark, sf):
    """Who moved from where to where on each play: hits, forced runners, errors, steals and caught steals."""
    return E.transitions(_told(spark, sf))


@query("scoring_credits", f"""{_MOVED_SQL}, c AS (SELECT game_id, runner AS player, (to_base = 4)::INT AS R, 0 AS RBI, (how = 'steal')::INT AS SB, (how = 'caught')::INT AS CS FROM moved UNION ALL SELECT game_id, batter, 0, batted_in::INT, 0, 0 FROM moved),
    t AS (SELECT game_id, player, CAST(coalesce(sum(R), 0) AS BIGINT) AS R, CAST(coalesce(sum(RBI), 0) AS BIGINT) AS RBI, CAST(sum(SB) AS BIGINT) AS SB, CAST(sum(CS) AS BIGINT) AS CS FROM c GROUP BY ALL),
    b AS (SELECT game_id, who AS player, count(*) FILTER (WHERE kind IN (2, 3, 4, 6, 7, 9)) AS AB, count(*) FILTER (WHERE kind IN (2, 6, 9)) AS H FROM o GROUP BY ALL)
    SELECT game_id, player, coalesce(AB, 0) AS AB, coalesce(H, 0) AS H, coalesce(R, 0) AS R, coalesce(RBI, 0) AS RBI, coalesce(SB, 0) AS SB, coalesce(CS, 0) AS CS FROM b FULL OUTER JOIN t USING (game_id, player)""", False)
def scoring_credits(spark, sf):
    """Runs, runs batted in and steals of each player out of the transitions, beside his times at bat and hits."""
    return E.player_totals(_told(spark, sf))


@query("discovered_games", """WITH p AS (SELECT page_id, DATE '2024-04-01' + CAST(page_id % 60 AS INT) AS day FROM pages), l AS (SELECT day, page_id, u.k AS k FROM p, unnest(range(0, 3)) AS u(k))
    SELECT DISTINCT CAST(day AS VARCHAR) AS day, 'https://x.test/boxes/T' || chr(CAST(65 + page_id % 26 AS INT)) || chr(CAST(65 + k AS INT)) || '/T' || chr(CAST(65 + page_id % 26 AS INT)) || chr(CAST(65 + k AS INT)) || strftime(day, '%Y%m%d') || '0.shtml' AS url
    FROM l WHERE day BETWEEN DATE '2024-04-10' AND DATE '2024-05-20' AND day < DATE '2024-05-11'""", False)
def discovered_games(spark, sf):
    """Games that stored index pages of some days name: each page's own HTML, with three games of its day, one of them twice, and one of another day."""
    d, day = F.col("page_id"), F.date_add(F.lit("2024-04-01").cast("date"), (F.col("page_id") % 60).cast("int"))
    code = lambda k: F.concat(F.lit("T"), F.chr(65 + d % 26), F.lit(chr(65 + k)))
    link = lambda k, on: F.concat(F.lit("<a href='/boxes/"), code(k), F.lit("/"), code(k), F.date_format(on, "yyyyMMdd"), F.lit("0.shtml'>x</a>"))
    html = F.concat(link(0, day), link(1, day), link(0, day), link(2, F.date_add(day, 1)), link(2, day), F.coalesce("html", F.lit("")))
    url = F.concat(F.lit("https://x.test/index?year="), F.year(day), F.lit("&month="), F.month(day), F.lit("&day="), F.dayofmonth(day), F.lit("&page="), d)
    path = f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    D.store_index(table(spark, sf, "pages").select(url.alias("url"), html.alias("html")), path)
    found = D.discover(spark, path, "2024-04-10", "2024-05-20", "https://x.test", F.lit("2024-05-11").cast("date"))
    return found.select(F.col("day").cast("string").alias("day"), "url")


@query("resolved_sides", """, k AS (SELECT DISTINCT game_id, team, player_id FROM batting), f AS (SELECT game_id, team, player_id, 'Ann' || player_id || ' Last' || (player_id % 5) AS who, player_id AS id, 'exact' AS how FROM k WHERE player_id % 2 = 0),
    g AS (SELECT game_id, team, player_id % 5 AS last, count(*) AS n, count(*) FILTER (WHERE player_id % 2 = 1) AS odd, min(player_id) FILTER (WHERE player_id % 2 = 1) AS single FROM k GROUP BY ALL)
    SELECT game_id, team, who, id AS player_id, how FROM f UNION ALL SELECT game_id, team, 'last' || last, CASE WHEN odd = 1 THEN single END, CASE WHEN odd = 1 AND n = 1 THEN 'last' WHEN odd = 1 THEN 'rest' END FROM g WHERE odd > 0""")
def resolved_sides(spark, sf):
    """Half of a side's players are called by their full names, the others by last names that they share with some of them."""
    (lines,) = B.dealt(spark, sf, ["game_id"], B.batting(spark, sf))
    known = lines.select("game_id", "team", "player_id").distinct()
    full, last = F.concat(F.lit("Ann"), "player_id", F.lit(" Last"), F.col("player_id") % 5), F.concat(F.lit("last"), F.col("player_id") % 5)
    asked = known.select("game_id", "team", F.when(F.col("player_id") % 2 == 0, full).otherwise(last).alias("who"))
    return N.resolve_sides(asked, known.withColumn("player_name", full))


@query("union_players_last_wins", """, u AS (SELECT player_id, 'B' || min(player_name) AS n, 1 AS s FROM batting WHERE flag = 'R' GROUP BY 1 UNION ALL SELECT player_id, 'P' || min(player_name), 0 FROM pitching GROUP BY 1) SELECT player_id, arg_min(n, s) AS player_name FROM u GROUP BY player_id""")
def union_players_last_wins(spark, sf):
    b = B.batting(spark, sf).where("flag = 'R'").select("player_id", F.concat(F.lit("B"), "player_name").alias("player_name"))
    p = B.pitching(spark, sf).select("player_id", F.concat(F.lit("P"), "player_name").alias("player_name"))
    return N.last_name_wins(b, p)


@query("text_numbers", """SELECT p_partkey, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) AS first_integer, CAST(p_size AS INT) AS leading_integer, 0 AS no_integer, CAST(trunc(p_retailprice) AS INT) AS safe_int, -1 AS unsafe_int,
    CASE WHEN lower(p_name[1]) = 't' THEN 'top' WHEN lower(p_name[1]) = 'b' THEN 'bottom' ELSE '' END AS inning_half FROM part""", False)
def text_numbers(spark, sf):
    """Numbers and half innings out of the parts' texts."""
    size = F.concat(F.col("p_size").cast("string"), F.lit("-("), "p_size", F.lit(")"))
    return table(spark, sf, "part").select(
        "p_partkey", T.first_integer("p_brand").alias("first_integer"), T.leading_integer(size).alias("leading_integer"), T.leading_integer("p_brand").alias("no_integer"), T.safe_int(F.col("p_retailprice").cast("string")).alias("safe_int"),
        T.safe_int("p_type", -1).alias("unsafe_int"), T.inning_half("p_name").alias("inning_half"),
    )


@query("name_pieces", """, n AS (SELECT player_id, player_name, nation_id, translate(player_name, '#0123456789', ' abcdefghij') AS name, ['SS', 'PH-LF', '1B', 'P'][CAST(nation_id % 4 AS INT) + 1] AS code FROM players)
    SELECT player_id, name AS player_name, CASE nation_id % 4 WHEN 1 THEN 'PH,LF' ELSE code END AS positions, CASE nation_id % 4 WHEN 0 THEN 'Shortstop' WHEN 1 THEN 'Pinch Hitter' WHEN 2 THEN 'First Base' ELSE 'Pitcher' END AS first_position,
    's' || lpad(CAST(player_id AS VARCHAR), 4, '0') AS link_id, name AS bare, 'https://x.test/boxes/SUP/SUP' || player_id || '.shtml' AS url, replace(player_name, 'Supplier#', 'Supplier Number#') AS words, CASE WHEN nation_id % 2 = 0 THEN player_name ELSE substr(player_name, 1, 7) || '...' END AS short FROM n""")
def name_pieces(spark, sf):
    """Suppliers' names with position codes, taken apart, and addresses and labels made of them."""
    rows = B.players(spark, sf).withColumn("name", F.translate("player_name", "#0123456789", " abcdefghij"))
    entry = F.concat("name", F.lit(" "), F.get(F.array(*map(F.lit, ("SS", "PH-LF", "1B", "P"))), (F.col("nation_id") % 4).cast("int")))
    taken, link = T.player_and_positions(entry), F.concat(F.lit("https://x.test/players/s/s"), F.lpad(F.col("player_id").cast("string"), 4, "0"), F.lit(".shtml"))
    short = F.when(F.col("nation_id") % 2 == 0, T.shortened("player_name", 99)).otherwise(T.shortened("player_name", 10))
    return rows.select(
        "player_id", taken["player_name"].alias("player_name"), F.array_join(taken["positions"], ",").alias("positions"), T.position_name(F.get(taken["positions"], F.lit(0))).alias("first_position"), T.player_id(link).alias("link_id"),
        T.without_code(entry).alias("bare"), T.game_url(F.concat(F.lit("SUP"), "player_id"), "https://x.test/").alias("url"), T.camel_words(F.replace("player_name", F.lit("Supplier#"), F.lit("SupplierNumber#"))).alias("words"), short.alias("short"),
    )


@query("details_totals", """, k AS (SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k FROM events) SELECT event_id, k + 1 AS HR, 2 AS doubles, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS SB FROM k""".replace(", k AS", "WITH k AS", 1), False)
def details_totals(spark, sf):
    """All stats of a details cell; a stat that comes twice adds up."""
    details = F.concat(F.regexp_extract("props", r"(\d+)", 1), F.lit("\u00b7HR, 2\u00b72B,HR"), F.when(F.col("event_id") % 2 == 0, ",SB").otherwise(""))
    rows = table(spark, sf, "events").select("event_id", T.detail_map(details).alias("m"))
    return rows.select("event_id", *(F.coalesce(F.try_element_at("m", F.lit(s)), F.lit(0)).alias(n) for s, n in (("HR", "HR"), ("2B", "doubles"), ("SB", "SB"))))


@query("game_flags", """SELECT o_orderkey AS game_id, CAST(o_custkey % 8 + 5 AS INT) < 9 OR o_orderpriority LIKE '1%' AS is_shortened, o_custkey % 8 + 5 > 9 AS is_extra, CASE o_orderstatus WHEN 'F' THEN 'World Series' WHEN 'O' THEN 'Division Series' END AS playoff_round, o_orderstatus IN ('F', 'O') AS is_playoff FROM orders""", False)
def game_flags(spark, sf):
    """Short, long and play-off games, by line scores and titles made of the orders' columns."""
    title = F.when(F.col("o_orderstatus") == "F", "A at B, World Series Game 1").when(F.col("o_orderstatus") == "O", "A at B - ALDS").otherwise("A at B")
    text = F.when(F.col("o_orderpriority").startswith("1"), F.concat("o_orderpriority", F.lit(": game called, rain"))).otherwise(F.col("o_orderpriority"))
    innings = M.innings_played(F.transform(F.sequence(F.lit(1), (F.col("o_custkey") % 8 + 5).cast("int")), lambda i: i.cast("string")), F.lit(0), text)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("game_id"), M.is_shortened(innings, text).alias("is_shortened"), M.is_extra_innings(innings).alias("is_extra"), M.playoff_round(title).alias("playoff_round"), M.is_playoff(title).alias("is_playoff"))


@query("bio_provenance", "SELECT player_id, CASE WHEN nation_id % 3 = 0 THEN 'Full ' || player_name ELSE player_name END AS full_name, CASE WHEN nation_id % 3 = 0 THEN throws END AS throws, CASE WHEN nation_id % 3 = 0 THEN 'bio' ELSE 'box_score' END AS source FROM players WHERE player_id % 4 <> 0")
def bio_provenance(spark, sf):
    """Players that the store lacks, with their facts where a page has them, and which of the two it was."""
    who = B.players(spark, sf)
    stored, seen = who.where("player_id % 4 = 0").select("player_id"), who.select("player_id", "player_name")
    bios = who.where("nation_id % 3 = 0").select("player_id", F.concat(F.lit("Full "), "player_name").alias("full_name"), "throws")
    return K.enrich_new_players(stored, seen, bios).select("player_id", "full_name", "throws", "source")


@query("pitching_outcomes", """SELECT pitcher_name, count(*) FILTER (WHERE event_type IN ('view', 'signup', 'purchase')) AS faced, count(*) FILTER (WHERE is_hit) AS hits_allowed, count(*) FILTER (WHERE is_walk) AS walks_allowed, count(*) FILTER (WHERE hit_type = 'home_run') AS home_runs_allowed,
    count(*) FILTER (WHERE is_so) AS outs FROM plays WHERE event_type IN ('view', 'signup', 'purchase') GROUP BY pitcher_name""")
def pitching_outcomes(spark, sf):
    rows = P.pitching_outcome(P.accepted(P.classify(B.raw_plays(spark, sf), rules=P.CONSERVATIVE_RULES, outcomes=P.CONSERVATIVE_OUTCOMES)))
    return rows.groupBy("pitcher_name").agg(F.count("*").alias("faced"), F.count_if("hit_allowed").alias("hits_allowed"), F.count_if("walk_allowed").alias("walks_allowed"), F.count_if("home_run_allowed").alias("home_runs_allowed"), F.count_if("out_recorded").alias("outs"))


@query("outcome_kinds", "SELECT seq, CASE event_type WHEN 'view' THEN 'strikeout' WHEN 'signup' THEN 'walk' WHEN 'purchase' THEN hit_type WHEN 'error' THEN 'error' END AS rule FROM plays")
def outcome_kinds(spark, sf):
    return P.kind(B.raw_plays(spark, sf)).select("seq", "rule")


@query("batted_in", """SELECT seq, CASE WHEN event_type = 'error' THEN 0 WHEN hit_type = 'home_run' THEN CASE seq % 3 WHEN 0 THEN 4 WHEN 1 THEN 3 ELSE 1 END WHEN seq % 3 = 0 THEN pitch_count WHEN seq % 3 = 1 THEN 2 ELSE 0 END AS rbi FROM plays""")
def batted_in(spark, sf):
    """Runs batted in as a description says them: by number, by the home run's name, by those who score, none on an error."""
    rows, k = B.raw_plays(spark, sf), F.col("seq") % 3
    home = F.when(k == 0, ", Grand Slam").when(k == 1, ", 3-run").otherwise("")
    other = F.when(k == 0, F.concat(F.lit("; "), "pitch_count", F.lit(" RBI"))).when(k == 1, "; Lee Scores; Diaz Scores").otherwise("")
    said = F.when(F.col("event_type") == "error", "Reached on error; Lee Scores").when(F.col("description").startswith("Home Run"), F.concat(F.lit("Home Run"), home)).otherwise(F.concat("description", other))
    return rows.select("seq", P.runs_batted_in(said).cast("long").alias("rbi"))


@query("stored_pages", """WITH p AS (SELECT page_id, length(html) % 800 AS age, CASE WHEN page_id % 2 = 0 THEN 'box_scores' ELSE 'rosters' END AS kind FROM pages)
    SELECT 'fresh' AS left_by, page_id FROM p WHERE age < CASE kind WHEN 'box_scores' THEN 720 ELSE 168 END UNION ALL SELECT 'cleared', page_id FROM p WHERE kind <> 'rosters'""", False)
def stored_pages(spark, sf):
    """What is left of a store of pages when old ones go, and when a kind of them does; their age follows from their length."""
    at = F.expr("timestamp '2024-06-01 00:00:00' - make_interval(0, 0, 0, 0, CAST(length(html) % 800 AS INT), 0, 0)")
    pages = table(spark, sf, "pages").where("html is not null").select("page_id", "html", at.alias("fetched_at"), F.when(F.col("page_id") % 2 == 0, F.lit("x/boxes/")).otherwise(F.lit("x/ROSTER")).alias("url"))
    path = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    C.append(spark, pages, path)
    held = C.read(spark, path)
    one = lambda name, df: df.select(F.lit(name).alias("left_by"), "page_id")
    return one("fresh", C.purge(held, F.lit("2024-06-01 00:00:00").cast("timestamp"))).unionByName(one("cleared", C.clear(held, "rosters")))


@query("recent_days", """, d AS (SELECT CAST(d AS DATE) AS day FROM unnest(generate_series(TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-21', INTERVAL 1 DAY)) AS u(d)) SELECT CAST(day AS VARCHAR) AS day, count(event_id) AS events FROM d LEFT JOIN events ON CAST(ts AS DATE) = day GROUP BY day""".replace(", d AS", "WITH d AS", 1), False)
def recent_days(spark, sf):
    """The fortnight up to a day, and what happened on each of its days."""
    counted = table(spark, sf, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("events"))
    return D.last_days(spark, 14, "2024-01-21").join(counted, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("events", F.lit(0)).alias("events"))


@query("report_upsert", """, f AS (SELECT game_id, validation_type, accuracy_percentage AS a, discrepancies_count AS n FROM reports)
    SELECT game_id, validation_type, CASE WHEN validation_type = 'batting' AND game_id % 3 > 0 THEN 'kept' WHEN coalesce(a, 0) >= 100 THEN 'success' WHEN coalesce(a, 0) >= 95 THEN 'warning' ELSE 'failure' END AS status, CASE WHEN validation_type = 'batting' AND game_id % 3 > 0 THEN a ELSE coalesce(a, 0) END AS accuracy_percentage,
    CASE WHEN validation_type = 'batting' AND game_id % 3 > 0 THEN 7 ELSE 9 END AS total_official, CASE WHEN validation_type = 'batting' AND game_id % 3 > 0 THEN 8 ELSE 9 END AS total_calculated, n AS discrepancies_count FROM f""")
def report_upsert(spark, sf):
    """Reports of both kinds stored in two batches; the second replaces a third of the first's, and adds the other side."""
    rows = B.reports(spark, sf)
    listed = rows.where("validation_type = 'batting'").select("game_id", "validation_type", F.lit("kept").alias("status"), "accuracy_percentage", F.lit(7).alias("total_official"), F.lit(8).alias("total_calculated"), F.array_repeat(F.lit("x"), F.col("discrepancies_count").cast("int")).alias("discrepancies"))
    counted = rows.where("validation_type = 'pitching' OR game_id % 3 = 0").select("game_id", "validation_type", F.col("accuracy_percentage").alias("accuracy"), F.lit(9).alias("players_compared"), F.col("discrepancies_count").alias("total_differences"))
    overall = counted.where("validation_type = 'pitching'").withColumn("validation_type", F.lit("overall"))
    store = V.Store(spark, f"{shared_folder(spark)}/reports-{uuid.uuid4().hex}", {"reports": V.Keyed(("game_id", "validation_type"), "game_id % 5", "new")})
    store.merge({"reports": R.report_rows(listed)})
    store.merge({"reports": R.report_rows(counted.unionByName(overall))})
    return store.read("reports")


@query("validation_views", """SELECT 'batting' AS side, player_id, count(*) AS n, CAST(sum(AB) AS BIGINT) AS a, CAST(sum(doubles) AS BIGINT) AS b FROM batting GROUP BY player_id UNION ALL SELECT 'pitching', player_id, count(*), CAST(sum(BF) AS BIGINT), CAST(0 AS BIGINT) FROM pitching GROUP BY player_id""")
def validation_views(spark, sf):
    """The columns of both sides that are compared, renamed, summed by player; what the tables lack stays out."""
    bat, pit = R.validation_view(B.batting(spark, sf), "batting"), R.validation_view(B.pitching(spark, sf), "pitching")
    assert bat.columns == ["player_id", "player_name", "team", "AB", "H", "BB", "SO", "PA", "R", "RBI", "HR", "2B", "3B", "SB", "HBP", "SF"] and pit.columns == ["player_id", "pitcher_name", "team", "BF"]
    one = lambda side, df, a, b: R.summed(df.withColumn("n", F.lit(1)), ["player_id"]).select(F.lit(side).alias("side"), "player_id", "n", F.col(a).alias("a"), b.cast("long").alias("b"))
    return one("batting", bat, "AB", F.col("2B")).unionByName(one("pitching", pit, "BF", F.lit(0)))


@query("heading_names", "SELECT page_id, unnest(CASE page_id % 2 WHEN 0 THEN ['Ann Lee', 'Sal Kim'] ELSE ['Ann Lee'] END) AS player_name FROM pages", False)
def heading_names(spark, sf):
    """Players named in heading cells of box scores in front of each page's own HTML: batters with codes, pitchers with decisions, headings and totals."""
    head = lambda text: f"<tr><th data-stat='player'>{text}</th><td>1</td></tr>"
    pitching = f"<table id='BBBpitching'>{head('Pitching')}{head('Sal Kim, W (1-0)')}{head('Ann Lee')}</table>"
    box = F.concat(F.lit(f"<table id='AAAbatting'>{head('Batting')}{head('Ann Lee SS')}{head('Ann Lee PH')}{head('Team Totals')}</table><table id='x'>{head('No One')}</table>"), F.when(F.col("page_id") % 2 == 0, pitching).otherwise(""))
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("url"), F.concat(box, F.coalesce("html", F.lit(""))).alias("html"))
    return N.from_cells(HP.cells(pages)).select(F.col("url").cast("long").alias("page_id"), "player_name")


@query("explorer_lines", """SELECT 'tables' AS line, 'games' AS name, count(*) AS n FROM games UNION ALL SELECT 'tables', 'players', count(*) FROM players UNION ALL SELECT 'query', venue, count(*) FROM games GROUP BY venue""")
def explorer_lines(spark, sf):
    """What an explorer's lines give: the tables' sizes, and a query over them that leaves no view."""
    tables = {"games": B.games(spark, sf), "players": B.players(spark, sf)}
    sizes = X.ask(spark, " tables; ", tables).select(F.lit("tables").alias("line"), F.col("table_name").alias("name"), F.col("n_rows").alias("n"))
    return sizes.unionByName(X.ask(spark, "SELECT 'query' AS line, venue AS name, count(*) AS n FROM games GROUP BY venue;", tables))


@query("appended_log", "SELECT validation_type, 2 * count(*) AS n, 2 * count(accuracy_percentage) AS known FROM reports GROUP BY validation_type")
def appended_log(spark, sf):
    """A batch's results appended twice to a log in CSV and read back."""
    path = f"{shared_folder(spark)}/log-{uuid.uuid4().hex}"
    for write in (RP.write_batch, ST.append_log):
        write(B.reports(spark, sf), path)
    held = ST.read_log(spark, path, "game_id long, validation_type string, accuracy_percentage double, discrepancies_count long")
    return held.groupBy("validation_type").agg(F.count("*").alias("n"), F.count("accuracy_percentage").alias("known"))


@query("batch_grades", "SELECT CASE WHEN accuracy_percentage >= 100 THEN 'perfect' WHEN accuracy_percentage >= 99 THEN 'good' ELSE 'needs_work' END AS grade, CASE WHEN accuracy_percentage >= 100 THEN 'success' WHEN accuracy_percentage >= 95 THEN 'warning' ELSE 'failure' END AS status, count(*) AS n FROM reports WHERE accuracy_percentage IS NOT NULL GROUP BY ALL")
def batch_grades(spark, sf):
    rows, a = B.reports(spark, sf).where("accuracy_percentage is not null"), F.col("accuracy_percentage")
    return rows.groupBy(R.grade(a).alias("grade"), R.report_status(a).alias("status")).agg(F.count("*").alias("n"))


@query("batch_report", f"""{_DIFFS}, g AS (SELECT game_id, CASE WHEN sum(official) > 0 THEN (sum(official) - sum(abs(diff))) / sum(official) * 100 ELSE 0 END AS accuracy FROM x GROUP BY game_id), s AS (SELECT stat, CAST(sum(abs(diff)) AS BIGINT) AS total, count(*) AS n FROM x WHERE diff <> 0 GROUP BY stat)
    SELECT 'Games: ' || count(*) AS line FROM g UNION ALL SELECT '  ' || stat || ' differs by ' || total || ' over ' || n || ' players' FROM s
    UNION ALL SELECT '  ' || CASE WHEN accuracy >= 100 THEN 'perfect' WHEN accuracy >= 99.5 THEN 'excellent' WHEN accuracy >= 99 THEN 'very_good' WHEN accuracy >= 98 THEN 'good' WHEN accuracy >= 95 THEN 'fair' ELSE 'poor' END || ': ' || count(*) FROM g GROUP BY CASE WHEN accuracy >= 100 THEN 'perfect' WHEN accuracy >= 99.5 THEN 'excellent' WHEN accuracy >= 99 THEN 'very_good' WHEN accuracy >= 98 THEN 'good' WHEN accuracy >= 95 THEN 'fair' ELSE 'poor' END""")
def batch_report(spark, sf):
    """A batch in words; the lines with rounded means are left to the tests."""
    lines = RP.text_report(R.accuracy(_diffs(spark, sf, ["game_id"]), ["game_id"]), _diffs(spark, sf))
    return lines.where(~F.col("line").rlike("^(Mean|Lowest)")).select("line")


@query("links_of_pages", """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="[^"]*?(/[A-Za-z]+)"', 1)) AS link FROM pages) SELECT DISTINCT page_id, link FROM l""", False)
def links_of_pages(spark, sf):
    """Each page's own links of a kind, once."""
    pages = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("url"), "html")
    return D.links(pages, "/[A-Za-z]+").select(F.col("url").cast("long").alias("page_id"), "link")


@query("play_rows", "SELECT seq FROM plays WHERE seq % 7 > 3")
def play_rows(spark, sf):
    """Plays alone: rows without an inning, a description or a pitcher go, and so do headings of innings."""
    k = F.col("seq") % 7
    raw = B.raw_plays(spark, sf).select("seq", F.when(k != 0, "t1").alias("inn"), F.when(k != 1, F.col("description")).alias("description"), F.when(k != 2, F.col("pitcher_name")).alias("pitcher"), F.when(k == 3, "TOP OF THE 3rd, Home ahead").when(k != 4, F.col("batter_name")).alias("batter"))
    return E.play_rows(raw).select("seq")


@query("played_links", "SELECT page_id FROM pages WHERE DATE '2024-04-01' + CAST(page_id % 60 AS INT) < DATE '2024-05-01' AND page_id % 3 <> 0", False)
def played_links(spark, sf):
    """Links of games before a day; an address without a date is none."""
    day = F.date_add(F.lit("2024-04-01").cast("date"), (F.col("page_id") % 60).cast("int"))
    link = F.concat(F.lit("/boxes/AAA/AAA"), F.when(F.col("page_id") % 3 == 0, "nodate").otherwise(F.date_format(day, "yyyyMMdd")), F.lit("0.shtml"))
    return D.played(table(spark, sf, "pages").select("page_id", link.alias("link")), F.lit("2024-05-01").cast("date")).select("page_id")


def _box(spark, sf, name, heads, lines):
    """Each page's own HTML behind a box-score table of the given headings and lines."""
    head = "".join(f"<th>{h}</th>" for h in heads)
    rows = [F.concat(F.lit("<tr>"), *(F.concat(F.lit("<td>"), c if not isinstance(c, str) else F.lit(c), F.lit("</td>")) for c in line), F.lit("</tr>")) for line in lines]
    html = F.concat(F.lit(f"<table id='{name}'><thead><tr>{head}</tr></thead><tbody>"), *rows, F.lit("</tbody></table>"), F.coalesce("html", F.lit("")))
    url = F.concat(F.lit("https://x.test/boxes/AAA/AAA2024"), F.lpad(F.col("page_id").cast("string"), 5, "0"), F.lit(".shtml?page="), F.col("page_id").cast("string"))
    return HP.rows(table(spark, sf, "pages").select(url.alias("url"), html.alias("html")))


@query("box_batting", """WITH p AS (SELECT 'AAA2024' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS game_id, CAST(page_id % 6 AS INT) AS n FROM pages)
    SELECT game_id, 'away' AS team, 1 AS row_idx, 'leean01' AS player_id, 'Ann Lee' AS player_name, 'CF,RF' AS positions, FALSE AS is_indented, n AS AB, n + 1 AS PA, n AS HR, 1 AS SB, 0 AS doubles FROM p
    UNION ALL SELECT game_id, 'away', 5, 'diazbo01', 'Bo Diaz', 'PH', TRUE, 1, 1, 0, 0, 2 FROM p""", False)
def box_batting(spark, sf):
    """Batters of a box score: a starter, totals, headings again, a blank line, a substitute, a pitcher who did nothing."""
    n = (F.col("page_id") % 6).cast("string")
    heads = ("Batting", "AB", "R", "H", "RBI", "BB", "SO", "PA", "Details")
    none = ("0",) * 6
    lines = [
        ("<a href='/players/l/leean01.shtml'>Ann Lee</a> CF-RF", n, "", "0", "0", "0", "0", (F.col("page_id") % 6 + 1).cast("string"), F.concat(n, F.lit("·HR,SB"))), ("Team Totals", *none, "9", ""), heads, ("", *none, "0", ""),
        ("&nbsp;&nbsp;<a href='/players/d/diazbo01.shtml'>Bo Diaz</a> PH", "1", "0", "0", "0", "0", "0", "1.0", "2·2B"), ("<a href='/players/f/foxra01.shtml'>Ray Fox</a> P", *none, "0", ""),
    ]
    rows = L.eligible_batters(HP.batting(_box(spark, sf, "AAAbatting", heads, lines)))
    return rows.select("game_id", "team", "row_idx", "player_id", "player_name", F.array_join("positions", ",").alias("positions"), "is_indented", "AB", "PA", "HR", "SB", "doubles")


@query("box_pitching", """WITH p AS (SELECT 'AAA2024' || lpad(CAST(page_id AS VARCHAR), 5, '0') AS game_id, CAST(page_id % 6 AS INT) AS n FROM pages)
    SELECT game_id, 'foxra01' AS player_id, 'Ray Fox' AS player_name, 'BS,W' AS decisions, n + 0.2 AS IP, n AS SO, 27 AS BF, 1 AS place FROM p UNION ALL SELECT game_id, NULL, 'Sal Kim', '', 1.0, 0, 3, 2 FROM p""", False)
def box_pitching(spark, sf):
    """Pitchers of a page's box score in order, with their decisions; one has no link. Ids of games have five digits of the page's, so pages may share one."""
    n = (F.col("page_id") % 6).cast("string")
    heads = ("Pitching", "IP", "H", "R", "ER", "BB", "SO", "HR", "BF", "Pit")
    lines = [("<a href='/players/f/foxra01.shtml'>Ray Fox</a>, BS (3), W (2-1)", F.concat(n, F.lit(".2")), "1", "1", "1", "1", n, "0", "27", "90"), ("Sal Kim", "1.0", "", "0", "0", "0", "x", "0", "3", "12"), ("Team Totals", "9.0", *("1",) * 8)]
    rows = L.pitching_order(HP.pitching(_box(spark, sf, "AAApitching", heads, lines), "url"), ("url", "team"))
    return rows.select("game_id", "player_id", "player_name", F.array_join("decisions", ",").alias("decisions"), F.col("IP").cast("double").alias("IP"), "SO", "BF", F.col("pitching_order").cast("int").alias("place"))
