import datetime as dt

from lodestar.operators import latest_snapshot, sample_for_dev


def test_latest_snapshot_by_version_with_tiebreak(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        (1, t(2024, 1, 1), 10, "old"), (1, t(2024, 1, 3), 11, "new"),
        (1, t(2024, 1, 3), 12, "newest-id"), (2, t(2024, 1, 2), 20, "only"),
    ], "user_id long, ts timestamp, event_id long, v string")
    got = {r.user_id: r.v for r in latest_snapshot(df, "user_id", ["ts", "event_id"]).collect()}
    assert got == {1: "newest-id", 2: "only"}
    assert latest_snapshot(df, "user_id", ["ts", "event_id"]).columns == df.columns


def test_sample_for_dev_is_ordered(spark):
    df = spark.range(100).selectExpr("(id * 37) % 100 as k").repartition(5)
    assert [r.k for r in sample_for_dev(df, "k", 5).collect()] == [0, 1, 2, 3, 4]


def test_latest_snapshot_with_a_map_column(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS v, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert [r.m for r in latest_snapshot(df, "k", "v").collect()] == [{"b": 2}]


def test_dev_sample_by_two_keys_is_repeatable(spark):
    df = spark.createDataFrame([("u", f"a{i}") for i in range(20)], "uid string, article_id string")
    for parts in (1, 3, 7):
        rows = sample_for_dev(df.repartition(parts), ["uid", "article_id"], 3).collect()
        assert [r.article_id for r in rows] == ["a0", "a1", "a10"]
