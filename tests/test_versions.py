"""The incremental store: batches, replays, failures, two writers, deletes."""

import pytest
from pyspark.sql import functions as F

from dugout import schemas
from dugout.operators.versions import Keyed, Store, Taken
from dugout.plans import demo, season
from dugout.streaming import ingest

TABLES = {
    "games": Keyed(("game_id",), "game_id div 10", "new", owner="game_id"),
    "plays": Keyed(("game_id", "seq"), "game_id div 10", "old", (("games", "game_id"),), "game_id"),
}


def batch(spark, ids, venue="v", plays=2):
    games = spark.createDataFrame([(i, i // 10, f"{venue}{i}") for i in ids], "game_id long, season long, venue string")
    return {"games": games, "plays": games.selectExpr("game_id", f"explode(sequence(1, {plays})) AS seq", "venue AS said")}


def shown(store, name, **which):
    return sorted(map(tuple, store.read(name, **which).collect()))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "s"), TABLES)


def files(store, name):
    return {p: x["dir"] for p, x in store.manifest()["tables"][name]["parts"].items()}


def test_two_batches_stay_and_only_touched_partitions_change(spark, store):
    assert store.merge(batch(spark, [1, 2, 11])) == 1
    before = files(store, "games"), files(store, "plays")
    assert store.merge(batch(spark, [2, 21], "w", plays=3)) == 2
    assert shown(store, "games") == [(1, 0, "v1"), (2, 0, "w2"), (11, 1, "v11"), (21, 2, "w21")]
    assert [r for r in shown(store, "plays") if r[0] == 2] == [(2, 1, "v2"), (2, 2, "v2"), (2, 3, "w2")]  # old rows stay
    after = files(store, "games"), files(store, "plays")
    for old, new in zip(before, after, strict=True):
        assert old["1"] == new["1"] and old["0"] != new["0"] and "2" in new
    assert shown(store, "games", version=1) == [(1, 0, "v1"), (2, 0, "v2"), (11, 1, "v11")]
    assert shown(store, "games", partitions=["1"]) == [(11, 1, "v11")]


def test_the_same_batch_again_changes_nothing(spark, store):
    for _ in range(2):
        assert store.merge(batch(spark, [1, 11])) == 1
    assert store.merge(batch(spark, [])) == 1 and store.merge(batch(spark, [11])) == 1


def test_a_numbered_batch_is_applied_once(spark, store):
    assert store.merge(batch(spark, [1]), ("s", 0)) == 1
    assert store.merge(batch(spark, [2]), ("s", 0)) == 1 and store.merge(batch(spark, [2]), ("s", 1)) == 2
    assert store.merge(batch(spark, [3]), ("other", 0)) == 3
    assert [r[0] for r in shown(store, "games")] == [1, 2, 3]


def test_failures_leave_the_old_version(spark, store, tmp_path):
    store.merge(batch(spark, [1]))
    bad = batch(spark, [2])
    with pytest.raises(ValueError, match="plays without a row of games"):
        store.merge({"plays": bad["plays"]})
    with pytest.raises(ValueError, match="more than one row"):
        store.merge({"games": bad["games"].unionByName(bad["games"].withColumn("venue", F.lit("x")))})
    with pytest.raises(Exception, match="boom"):
        store.merge({"games": bad["games"], "plays": bad["plays"].withColumn("said", F.expr("raise_error('boom')").cast("string"))})
    assert shown(store, "games") == [(1, 0, "v1")] and store.manifest()["version"] == 1
    assert len(list((tmp_path / "s" / "data").iterdir())) == 1  # what failed left no files


def test_parents_may_be_stored_already(spark, store):
    store.merge({"games": batch(spark, [1])["games"]})
    assert store.merge({"plays": batch(spark, [1])["plays"]}) == 2


def interrupted(store, other, monkeypatch, times=1):
    """Another writer commits between this one's reading and its commit."""
    real, left = store._commit, [times]

    def commit(manifest):
        if left[0]:
            left[0] -= 1
            other()
        return real(manifest)

    monkeypatch.setattr(store, "_commit", commit)


def test_two_writers_of_other_partitions(spark, store, monkeypatch):
    store.merge(batch(spark, [1]))
    second = Store(spark, store.root, TABLES)
    interrupted(store, lambda: second.merge(batch(spark, [31])), monkeypatch)
    written = []
    monkeypatch.setattr(store, "_write", lambda *a, real=store._write: written.append(a) or real(*a))
    assert store.merge(batch(spark, [41])) == 3
    assert [r[0] for r in shown(store, "games")] == [1, 31, 41] and len(written) == 2  # a table each: nothing was merged again


def test_two_writers_of_one_partition(spark, store, monkeypatch):
    store.merge(batch(spark, [1]))
    second = Store(spark, store.root, TABLES)
    interrupted(store, lambda: second.merge(batch(spark, [2, 3], "other")), monkeypatch)
    assert store.merge(batch(spark, [3, 4], "mine")) == 3
    assert shown(store, "games") == [(1, 0, "v1"), (2, 0, "other2"), (3, 0, "mine3"), (4, 0, "mine4")]
    n = iter(range(5, 99))
    interrupted(store, lambda: second.merge(batch(spark, [next(n)])), monkeypatch, times=99)
    with pytest.raises(Taken):
        store.merge(batch(spark, [4], "late"), tries=2)
    assert shown(store, "games")[3] == (4, 0, "mine4")


def test_deletes_write_no_data(spark, store, tmp_path):
    store.merge(batch(spark, [1, 2, 11, 12]))
    data = lambda: {p.parent for p in (tmp_path / "s").rglob("*.parquet")}
    before, held = data(), files(store, "games")
    gone = spark.createDataFrame([(2,), (2,), (11,), (99,)], "game_id long")
    assert {tuple(r) for r in store.hidden_by(gone).collect()} == {("games", 2), ("plays", 4)}
    store.delete(gone)
    assert [r[0] for r in shown(store, "games")] == [1, 12] and shown(store, "plays") == [(1, 1, "v1"), (1, 2, "v1"), (12, 1, "v12"), (12, 2, "v12")]
    assert files(store, "games") == held and all("hides" in str(p) for p in data() - before)
    assert [r[0] for r in shown(store, "games", version=1)] == [1, 2, 11, 12]
    between = data()
    store.delete_partition("1")
    assert [r[0] for r in shown(store, "games")] == [1] and data() == between  # a season goes by the manifest alone
    store.merge(batch(spark, [2], "again"))
    assert shown(store, "games") == [(1, 0, "v1"), (2, 0, "again2")] and not store.manifest()["tables"]["games"]["parts"]["0"]["hides"]
    store.delete(gone)
    store.compact()
    assert not any(x["hides"] for t in store.manifest()["tables"].values() for x in t["parts"].values()) and [r[0] for r in shown(store, "games")] == [1]
    store.delete(spark.createDataFrame([(1,)], "game_id long"))
    store.compact()
    assert shown(store, "games") == [] and store.manifest()["tables"]["games"]["parts"] == {}


def test_forget_keeps_what_a_version_names(spark, store, tmp_path):
    for ids in ([1, 11], [2], [3]):
        store.merge(batch(spark, ids))
    (tmp_path / "s" / "data" / "under-way").mkdir()
    store.forget()
    assert [r[0] for r in shown(store, "games")] == [1, 2, 3, 11] and store._numbers() == [3]
    named = {x["dir"] for t in store.manifest()["tables"].values() for x in t["parts"].values()}
    there = {str(p.parent.relative_to(tmp_path / "s")) for p in (tmp_path / "s" / "data").rglob("*.parquet")}
    assert there == named and (tmp_path / "s" / "data" / "under-way").exists()
    store.forget(orphan_hours=-1)
    assert not (tmp_path / "s" / "data" / "under-way").exists()


def test_a_large_partition_is_written_by_several_tasks(spark, store, tmp_path):
    """All rows are of one partition: many files, each sorted by the key."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        store.merge({"games": spark.range(9_000).selectExpr("id % 9 AS season", "id * 0 AS zero", "sha2(CAST(id AS STRING), 256) AS venue", "id").selectExpr("id % 10 AS game_id", "season", "venue").dropDuplicates(["game_id"])})
        lots = spark.range(40_000).selectExpr("id % 10 AS game_id", "id AS seq", "sha2(CAST(id AS STRING), 256) AS said")
        store.merge({"plays": lots})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = list((tmp_path / "s" / files(store, "plays")["0"]).glob("*.parquet"))
    assert len(written) >= 3 and store.read("plays").count() == 40_000
    for f in written[:3]:
        rows = [(r["game_id"], r["seq"]) for r in spark.read.parquet(str(f)).collect()]
        assert rows == sorted(rows)


def test_odd_keys_and_partitions(spark, store):
    odd = {"games": Keyed(("game_id", "venue"), "venue", "old")}
    other = Store(spark, f"{store.root}-odd", odd)
    rows = [(None, 1, None), (1, 1, "a/b=c"), (1, 1, ""), (None, 2, "x")]
    for _ in range(2):
        assert other.merge({"games": spark.createDataFrame(rows, "game_id long, season long, venue string")}) == 1
    assert sorted(map(tuple, other.read("games").collect()), key=str) == sorted(rows, key=str)
    with pytest.raises(KeyError):
        other.read("plays")


# --- the season's store --------------------------------------------------------------------------------------------


def test_season_in_batches(spark, tmp_path):
    """Two batches, one game in both and one page twice: the store holds each game once, with all its tables."""
    root, pages = str(tmp_path / "store"), demo.pages(spark, 6).cache()
    number = F.regexp_extract("url", "n=(\\d+)", 1).cast("int")
    season.store(pages.where(number < 3), root)
    counts = {r["table_name"]: r["n"] for r in season.store(pages.where(number >= 2).unionByName(pages.where(number == 4)), root).collect()}
    held = schemas.season_store(spark, root)
    assert counts["games"] == 6 and counts["batting_appearances"] == 6 * 18 and counts["pitching_appearances"] == 12 and counts["validation_reports"] == 12 and counts["players"] == 6 * 20
    events = held.read("events")
    assert events.count() == events.select("event_id").distinct().count() == season.silver(pages)["events"].count()
    assert all(schemas.repeated_keys(held.read(n), n).count() == 0 for n in schemas.TABLES)
    assert all([f.name for f in held.read(n).schema] == [c.split()[0] for c in schemas.TABLES[n].replace("decimal(4,1)", "decimal").split(", ")] for n in schemas.TABLES)
    version = held.manifest()["version"]
    season.store(pages, root)
    season.store(pages, root, again=True)
    assert held.manifest()["version"] == version


def test_bios_reach_new_players(spark, tmp_path):
    root, pages = str(tmp_path / "store"), demo.pages(spark, 1)
    some = season.silver(pages)["batting"].where("player_id is not null").first()["player_id"]
    bios = spark.createDataFrame([(some, "Full Name", "R")], "player_id string, full_name string, bats string")
    season.store(pages, root, bios=schemas.conformed(bios, "players"))
    players = {r["player_id"]: (r["full_name"], r["bats"]) for r in schemas.season_store(spark, root).read("players").collect()}
    assert players[some] == ("Full Name", "R") and all(n and (b is None or p == some) for p, (n, b) in players.items())


def test_a_stream_that_dies_between_store_and_checkpoint(spark, tmp_path):
    """The batch was stored, its number wasn't noted: the next start brings it again, and nothing is stored twice."""
    folder, root, state = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "state")
    number = F.regexp_extract("url", "n=(\\d+)", 1).cast("int")
    pages = demo.pages(spark, 4).withColumn("fetched_at", F.timestamp_seconds(number + 1700000000)).cache()
    pages.where(number < 2).coalesce(1).write.mode("append").parquet(folder)
    calls = []

    def dies(batch, n):
        ingest.into_store(root)(batch, n)
        calls.append(n)
        raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        ingest.start(ingest.page_stream(spark, folder), dies, state).awaitTermination(180)
    held = schemas.season_store(spark, root)
    assert calls == [0] and held.read("games").count() == 2 and held.manifest()["version"] == 1
    pages.where(number >= 2).coalesce(1).write.mode("append").parquet(folder)
    ingest.start(ingest.page_stream(spark, folder), ingest.into_store(root), state).awaitTermination(180)
    assert held.read("games").count() == 4 and held.manifest()["sources"] == {"pages": 1} and held.manifest()["version"] == 2
    assert schemas.repeated_keys(held.read("events"), "events").count() == 0
