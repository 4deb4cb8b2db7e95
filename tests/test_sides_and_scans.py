"""Names of a side, discovery over stored index pages, database scans, metrics of a batch."""

import random
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from dugout import schemas
from dugout.operators import names as N
from dugout.plans import demo, season
from dugout.sources import box_pages as B
from dugout.sources import schedule, tables

# --- names ---------------------------------------------------------------------------------------------------------


def keys(name):
    bare = re.sub(r"[.\s ]+", " ", re.sub(N.SUFFIXES, "", name).lower()).strip()
    rest = re.match(r"^\S+ (?:\S )?(.+)$", bare)
    return [name, bare, f"{bare[0]} {rest[1]}" if rest else "", bare.split(" ")[-1]]


def brute(asked, players):
    """Kind by kind, then elimination until nothing changes."""
    found = {}
    for who in asked:
        for kind in range(3 if re.search(r"\S[\s.]+\S", who.strip()) else 4):
            ids = {i for n, i in players if keys(n)[kind] and keys(n)[kind] in [keys(who)[kind]]}
            if ids:
                found[who] = [kind, ids, len(ids) == 1]
                break
    changed = True
    while changed:
        taken, changed = {next(iter(ids)) for _, ids, _ in found.values() if len(ids) == 1}, False
        for x in found.values():
            if len(x[1]) > 1 and x[1] & taken:
                x[1], changed = x[1] - taken, True
    how = lambda kind, ids, sure: ("exact", "spelling", "initial", "last")[kind] if sure else "rest"
    return {who: (next(iter(found[who][1])), how(*found[who])) if who in found and len(found[who][1]) == 1 else (None, None) for who in asked}


def resolved(spark, sides):
    asked = [(g, "home", who) for g, (names, _) in sides.items() for who in names]
    players = [(g, "home", n, i) for g, (_, known) in sides.items() for n, i in known]
    got = N.resolve_sides(spark.createDataFrame(asked, "game_id string, team string, who string"), spark.createDataFrame(players, "game_id string, team string, player_name string, player_id string"))
    out = {}
    for r in got.collect():
        out.setdefault(r["game_id"], {})[r["who"]] = (r["player_id"], r["how"])
    return out


KNOWN = [("Ann Lee", "l1"), ("Abe Lee", "l2"), ("Ken Roy Jr.", "r1"), ("Juan De La Cruz", "c1"), ("A.J. Fox", "f1"), ("Mike Trout", "t1"), ("Zoë Lee", "l3")]


def test_names_of_a_side(spark):
    got = resolved(spark, {"g": (["Ann Lee", "ABE LEE", "Lee", "K. Roy", "J. De La Cruz", "Fox", "Michael Trout", "Nobody", "A. Lee", " Roy "], KNOWN), "h": (["Lee", "A. Lee", "Cruz"], KNOWN)})
    assert got["g"] == {
        "Ann Lee": ("l1", "exact"), "ABE LEE": ("l2", "spelling"), "Lee": ("l3", "rest"), "K. Roy": ("r1", "initial"), "J. De La Cruz": ("c1", "initial"), "Fox": ("f1", "last"), "Michael Trout": ("t1", "initial"), "Nobody": (None, None),
        "A. Lee": (None, None), " Roy ": ("r1", "last"),
    }
    assert got["h"] == {"Lee": (None, None), "A. Lee": (None, None), "Cruz": ("c1", "last")}


def test_names_against_brute_force(spark):
    rng, sides = random.Random(8), {}
    for g in range(60):
        known = [(f"{rng.choice(['Ann', 'Abe', 'Bo', 'Cy', 'B.J.'])} {rng.choice(['Lee', 'Fox', 'De Lee'])}{rng.choice(['', '', ' Jr.'])}", f"p{i}") for i in range(rng.randint(1, 6))]
        asked = {rng.choice([n, n.upper(), n.split(" ")[-1] if "Jr" not in n else n, f"{n[0]}. {n.split(' ', 1)[1]}", "Lee", "Fox", "Zed"]) for n, _ in known for _ in range(2)}
        sides[f"g{g}"] = (sorted(asked), known)
    got = resolved(spark, sides)
    for g, (asked, known) in sides.items():
        assert got[g] == brute(asked, known), (g, known)


def test_names_without_keys(spark):
    """Empty names meet nobody and stay; nulls fall out; a game without an id is a game."""
    asked = [("g", "home", ""), ("g", "home", " "), ("g", "home", None), ("g", "home", "Lee"), ("g", "home", "Lee"), ("h", "home", None), (None, "home", "Ann Lee")]
    players = [("g", "home", "", "p0"), ("g", "home", None, "p1"), ("g", "home", "Ann Lee", None), ("g", "home", "Bo Lee", "p2"), (None, "home", "Ann Lee", "p3")]
    got = N.resolve_sides(spark.createDataFrame(asked, "game_id string, team string, who string"), spark.createDataFrame(players, "game_id string, team string, player_name string, player_id string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("g", "home", "", None, None), ("g", "home", " ", None, None), ("g", "home", "Lee", "p2", "last"), (None, "home", "Ann Lee", "p3", "exact")], key=str)


def test_names_of_empty_tables(spark):
    assert N.resolve_sides(spark.createDataFrame([], "game_id string, team string, who string"), spark.createDataFrame([], "game_id string, team string, player_name string, player_id string")).collect() == []


# --- discovery -----------------------------------------------------------------------------------------------------


def index(day, *links, more=""):
    return (f"https://x.test/boxes/index.fcgi?year={day[:4]}&month={int(day[5:7])}&day={int(day[8:])}{more}", "".join(f'<a href="{x}">g</a>' for x in links))


def link(team, day, n=0):
    return f"/boxes/{team}/{team}{day.replace('-', '')}{n}.shtml"


def test_discovery_reads_the_days_it_is_asked_for(spark, tmp_path):
    a, b, c, d = "2024-03-01", "2024-04-02", "2024-11-30", "2025-04-01"
    rows = [index(a, link("AAA", a), link("BBB", a), link("AAA", a)), index(b, link("CCC", a), "https://y.test" + link("DDD", b), link("EEE", b, 2)), index(c, link("FFF", c)), index(d, link("GGG", d)), ("https://x.test/no-day", link("HHH", a))]
    path = str(tmp_path / "index")
    schedule.store_index(spark.createDataFrame(rows, "url string, html string"), path)
    today = F.lit("2025-01-01").cast("date")
    found = schedule.season_games(spark, path, 2024, "https://x.test/", today)
    got = [(str(r["day"]), r["url"]) for r in found.orderBy("day", "place").collect()]
    assert got == [(a, "https://x.test" + link("AAA", a)), (a, "https://x.test" + link("BBB", a)), (b, "https://x.test" + link("DDD", b)), (b, "https://x.test" + link("EEE", b, 2)), (c, "https://x.test" + link("FFF", c))]
    plan = schedule.discover(spark, path, "2024-04-01", "2024-04-30", today=today)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text and "DataFilters: []" in text
    assert [str(r["day"]) for r in plan.select("day").distinct().collect()] == [b]
    assert len(spark.read.parquet(path).where(F.col("day").between("2024-04-01", "2024-04-30")).inputFiles()) >= 1


# --- databases -----------------------------------------------------------------------------------------------------


@pytest.fixture
def database(spark, tmp_path):
    url, options = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).selectExpr("CAST(id * 3 AS INT) AS game_no", "concat('v', id % 7) AS venue").coalesce(1).write.format("jdbc").options(url=url, dbtable="games", createTableColumnTypes="venue VARCHAR(20)", **options).save()
    return url, options


def test_scan_of_a_database(spark, database):
    url, options = database
    games = tables.scan(spark, url, "games", "game_no", parts=4, **options)
    assert games.rdd.getNumPartitions() == 4 and games.count() == 100
    sizes = [len(p) for p in games.rdd.glom().collect()]
    assert max(sizes) <= 27 and sum(sizes) == 100
    some = games.where("game_no >= 150 AND venue = 'v1'").select("game_no")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(game_no,150)" in plan.replace("*", "") and "EqualTo(venue,v1)" in plan.replace("*", "") and sorted(r[0] for r in some.collect()) == [i * 3 for i in range(50, 100) if i % 7 == 1]
    spark.createDataFrame([], "game_no int, venue string").write.format("jdbc").options(url=url, dbtable="no_games", **options).save()
    assert tables.scan(spark, url, "no_games", "game_no", **options).count() == 0


def test_reachable(spark, database):
    url, options = database
    assert tables.reachable(spark, url, "SELECT COUNT(*) AS n FROM games", **options) is None
    assert tables.reachable(spark, url, "SELECT COUNT(*) AS n FROM missing", **options)
    assert tables.reachable(spark, "jdbc:derby:/nowhere/at/all", **options)


# --- metrics -------------------------------------------------------------------------------------------------------


def test_metrics_come_out_of_the_run_itself(spark, tmp_path):
    pages, watch = demo.pages(spark, 3).unionByName(spark.createDataFrame([("https://x.test/boxes/ZZZ/ZZZ202404010.shtml", None)], "url string, html string")).cache(), Observation()
    season.store(pages, str(tmp_path / "store"), watch=watch)
    got, rows = season.timed(watch), B.rows(pages)
    assert (got["pages"], got["failed"]) == (4, 1) and got["table_rows"] == rows.where("table_id <> '#page'").count()
    assert 0 < got["slowest"] <= got["seconds"] and got["seconds_a_page"] == got["seconds"] / 4
    assert schemas.season_store(spark, str(tmp_path / "store")).read("games").count() == 3
