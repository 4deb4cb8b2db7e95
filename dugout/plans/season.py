"""A season in one plan: pages to relations, ids, reconciliation, gate. What was a loop over games is a set of joins."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas
from ..functions import plays as P
from ..functions import text as T
from ..operators import events as E
from ..operators import lineup as L
from ..operators import names as N
from ..operators import reconcile as R
from ..operators import store as K
from ..sources import box_pages as B


class Kept:
    """Tables that a plan reads several times, on the executors' disks until release(). A lost executor's are computed again."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        self.tables.append(df.persist(StorageLevel.DISK_ONLY))
        return self.tables[-1]

    def release(self) -> None:
        while self.tables:
            self.tables.pop().unpersist()


def one_page_a_game(pages: DataFrame) -> DataFrame:
    """pages(url, html) with one page for each game, the one fetched last if fetched_at says so.

    Only pages of games that come more than once are moved; which these are, if any, is told from the addresses alone.
    """
    key = F.when(T.game_id("url") != "unknown", T.game_id("url")).otherwise(F.col("url"))
    keyed = pages.withColumn("_key", key)
    again = keyed.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key")
    if again.isEmpty():
        return pages
    order = F.struct(*([F.col("fetched_at")] if "fetched_at" in pages.columns else []), F.col("url"), F.xxhash64("html"))
    last = keyed.join(again, "_key", "left_semi").groupBy("_key").agg(F.max_by(F.struct(*pages.columns), order).alias("p")).select("p.*")
    return keyed.join(again, "_key", "left_anti").select(*pages.columns).unionByName(last)


def silver(pages: DataFrame, kept: Kept | None = None, watch: Observation | None = None) -> dict[str, DataFrame]:
    """games, batting, pitching, events, events_rejected, ambiguous_names and page_errors of pages(url, html).

    Pages are parsed once. watch: gets the metrics of box_pages.measured().
    """
    kept = kept or Kept()
    rows = kept(B.measured(B.rows(pages), watch) if watch else B.rows(pages))
    batting = kept(L.batting_order(L.eligible_batters(B.batting(rows))))
    pitching = kept(L.pitching_order(B.pitching(rows)))
    raw = E.play_rows(B.plays(rows))
    parsed = raw.select("game_id", "seq", T.first_integer("inn").alias("inning"), T.inning_half("inn").alias("inning_half"), T.normal_name("batter").alias("batter_name"), T.normal_name("pitcher").alias("pitcher_name"), "description", T.leading_integer("pit_cnt").alias("pitch_count"))
    judged = kept(P.classify(E.with_sides(parsed)))
    events = E.renumber(E.dedup_pitch_counts(P.accepted(judged)))
    names = N.canonical(batting, pitching, ("game_id", "team"))
    events = N.enrich(events, names.drop("is_ambiguous"))
    events = kept(events.withColumn("event_id", E.event_id("game_id", "inning", "inning_half", "seq")))
    return {
        "games": B.games(rows),
        "batting": batting,
        "pitching": pitching,
        "events": events,
        "events_rejected": P.rejected(judged),
        "ambiguous_names": names.where("is_ambiguous").select("game_id", "team", "player_name"),
        "page_errors": B.page_errors(rows),
    }


def reports(tables: dict[str, DataFrame]) -> DataFrame:
    """(game_id, validation_type, accuracy_percentage, discrepancies_count, status) for batting and pitching.

    Players are matched on their side, so namesakes of two teams are compared apart. Two of one name in one team are one
    line on both sides of the comparison.
    """
    keys = ["game_id", "team", "player_name"]
    events = tables["events"]
    sides = (
        ("batting", tables["batting"], R.batter_lines(events.withColumn("team", F.col("batting_team")), ("game_id", "team")), R.BATTING),
        ("pitching", tables["pitching"], R.pitcher_lines(events.withColumn("team", F.col("pitching_team")), ("game_id", "team")), R.PITCHING),
    )
    out = None
    for name, official, parsed, stats in sides:
        diffs = R.differences(official.groupBy(*keys).agg(*(F.sum(s).alias(s) for s in stats)), parsed, keys, stats)
        one = R.accuracy(diffs, ["game_id"]).select("game_id", F.lit(name).alias("validation_type"), F.col("accuracy").alias("accuracy_percentage"), F.col("total_differences").cast("int").alias("discrepancies_count"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", R.report_status(F.col("accuracy_percentage")))


def gate(report_rows: DataFrame, least: float = 95.0, strict: bool = True) -> DataFrame:
    """(game_id, batting_accuracy, pitching_accuracy, status) of the games to store."""
    at = lambda t: F.max(F.when(F.col("validation_type") == t, F.col("accuracy_percentage")))
    both = report_rows.groupBy("game_id").agg(at("batting").alias("batting_accuracy"), at("pitching").alias("pitching_accuracy"))
    return R.storable(both.withColumn("status", R.status(F.col("batting_accuracy"), F.col("pitching_accuracy"), least)), least, strict)


#: Tables about pages and games that failed, which the gate does not cut.
ABOUT = ("page_errors",)


def process(pages: DataFrame, stored_games: DataFrame | None = None, least: float = 95.0, strict: bool = True, kept: Kept | None = None, watch: Observation | None = None) -> dict[str, DataFrame]:
    """silver tables of the games that pass, without those stored before, the reports of all new ones and page errors."""
    kept = kept or Kept()
    new = pages if stored_games is None else pages.withColumn("game_id", T.game_id("url")).join(stored_games.select("game_id"), "game_id", "left_anti").drop("game_id")
    tables = silver(new, kept, watch)
    rows = kept(reports(tables))
    good = kept(gate(rows, least, strict).select("game_id"))
    return {name: df if name in ABOUT else df.join(good, "game_id", "left_semi") for name, df in tables.items()} | {"validation_reports": rows}


def stored_tables(tables: dict[str, DataFrame], bios: DataFrame | None = None) -> dict[str, DataFrame]:
    """process() as the stored tables: players with their facts where bios() has them, appearances once a player and side."""
    out = {"games": tables["games"], "events": tables["events"], "validation_reports": tables["validation_reports"]}
    for kind in ("batting", "pitching"):
        keys = list(schemas.STORED[f"{kind}_appearances"].keys)
        out[f"{kind}_appearances"] = K.first_of(tables[kind], keys, ["row_idx"])
    seen = N.first_name_wins(*(tables[k].where("player_id is not null") for k in ("batting", "pitching")))
    known = bios.dropDuplicates(["player_id"]) if bios is not None else schemas.empty(seen.sparkSession, "players")
    out["players"] = seen.join(known, "player_id", "left").withColumn("full_name", F.coalesce("full_name", "player_name"))
    return {n: schemas.conformed(df, n) for n, df in out.items()} | {n: tables[n] for n in ("events_rejected", "ambiguous_names", "page_errors")}


def store(pages: DataFrame, root: str, least: float = 95.0, strict: bool = True, bios: DataFrame | None = None, again: bool = False, source: tuple[str, int] | None = None, watch: Observation | None = None) -> DataFrame:
    """(table_name, n): a batch of pages processed and merged into the store under root as one version, and what it holds then.

    Games that are stored already are skipped, unless `again`. A page that comes twice counts once. bios: facts of players for
    those who are new. source: a stream's name and the batch's number, which is applied once. watch: gets the batch's metrics, see
    timed().
    """
    kept, held = Kept(), schemas.season_store(pages.sparkSession, root)
    try:
        known = held.manifest()["tables"]
        old = held.read("games") if "games" in known and not again else None
        held.merge(stored_tables(process(one_page_a_game(pages), old, least, strict, kept, watch), bios), source)
    finally:
        kept.release()
    return reduce(DataFrame.unionByName, (held.read(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in held.manifest()["tables"]))


def timed(watch: Observation) -> dict[str, float]:
    """A batch's pages, failures, rows and reading times, and the mean time a page, out of the run that stored it."""
    found = watch.get
    return found | {"seconds_a_page": found["seconds"] / found["pages"] if found["pages"] else 0.0}


def outcomes(pages: DataFrame, tables: dict[str, DataFrame], stored_games: DataFrame | None = None) -> DataFrame:
    """(game_id, url, processing_status, error): what became of each page of a batch: skipped, error or success."""
    rows = pages.select(T.game_id("url").alias("game_id"), "url").join(tables["page_errors"].select("url", "error"), "url", "left")
    known = (stored_games.select("game_id") if stored_games is not None else rows.select("game_id").limit(0)).distinct().withColumn("known", F.lit(True))
    state = F.when(F.col("known"), "skipped").when(F.col("error").isNotNull(), "error").otherwise("success")
    return rows.join(known, "game_id", "left").select("game_id", "url", state.alias("processing_status"), "error")
