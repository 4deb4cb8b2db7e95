import datetime

import pytest

from dugout.operators import store as K
from dugout.streaming import ingest


def test_upsert_insert_delete(spark):
    """Of new rows with one key the last, or the first, that arrived counts, whatever its values."""
    old = spark.createDataFrame([(1, "z"), (2, "b")], "game_id long, v string")
    new = spark.createDataFrame([(2, "x", 1), (3, "q", 2), (3, "p", 3), (1, "y", 4), (1, "c", 5)], "game_id long, v string, arrived int")
    assert sorted(map(tuple, K.upsert(old, new, ["game_id"], ["arrived"]).collect())) == [(1, "c"), (2, "x"), (3, "p")]
    assert sorted(map(tuple, K.insert_if_absent(old, new, ["game_id"], ["arrived"]).collect())) == [(1, "z"), (2, "b"), (3, "q")]
    gone = new.where("game_id <> 1")
    assert K.delete_games({"t": old}, gone)["t"].collect() == [(1, "z")]
    assert [tuple(r) for r in K.deletions({"t": old}, gone).collect()] == [("t", 1)]


def test_publish_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        K.publish(spark, spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]


def test_publish_puts_the_old_table_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    K.publish(spark, spark.range(3), path)
    real = K._files(spark, path)

    class Failing:
        """The second rename, that of the new table, fails."""

        calls = 0

        def rename(self, a, b):
            Failing.calls += 1
            return Failing.calls != 2 and real.rename(a, b)

        exists, delete = real.exists, real.delete

    monkeypatch.setattr(K, "_files", lambda *_: Failing())
    with pytest.raises(OSError, match="the old table stands"):
        K.publish(spark, spark.range(5), path)
    assert spark.read.parquet(path).count() == 3


def test_stream_takes_each_game_once(spark, tmp_path):
    day = datetime.datetime(2024, 4, 2)
    rows = [("https://x.test/boxes/BBB/BBB202404010.shtml", "a", day), ("https://x.test/boxes/BBB/BBB202404010.shtml", "b", day), ("https://x.test/boxes/BBB/BBB202404020.shtml", "c", day)]
    spark.createDataFrame(rows, ingest.PAGES).write.parquet(str(tmp_path / "in"))
    seen = []
    q = ingest.start(ingest.page_stream(spark, str(tmp_path / "in")), lambda batch, _: seen.extend(r["game_id"] for r in batch.collect()), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert sorted(seen) == ["BBB202404010", "BBB202404020"]


def test_recommendations_and_settings(spark):
    from dugout.operators import reconcile as R
    from dugout.sources import tables

    results = spark.createDataFrame([(90.0,), (99.0,)], "accuracy double")
    diffs = spark.createDataFrame([("H", 2.0), ("SO", -1.0)], "stat string, diff double")
    said = [r["recommendation"] for r in R.recommendations(results, diffs).collect()]
    assert len(said) == 3 and "Look at H first" in said[2]
    with pytest.raises(KeyError, match="DB_PORT"):
        tables.settings({"DB_HOST": "x"})
