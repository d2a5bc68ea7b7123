"""Day-partitioned events and snapshots folded from changes."""

import glob
import os
import random

from pyspark.sql import functions as F

from lodestar.operators import (
    article_clicks, document_vectors, fold_changes, keyword_vectors, latest_snapshot,
    read_snapshot, user_embedding,
)
from lodestar.sources import on_days, read_partitions, replace_partitions, save_table

EVENTS = ("distinct_id string, article_id string, logday string, event string, "
          "element_page string")


def events(spark):
    return spark.createDataFrame(
        [(f"u{i % 5}", str(i % 7), f"202401{1 + i % 9:02d}", "AppClick" if i % 3 else "View",
          "内容详情页") for i in range(200)], EVENTS)


def files(path):
    return {d: {(f, os.path.getmtime(f)) for f in glob.glob(f"{d}/*.parquet")}
            for d in glob.glob(f"{path}/*=*")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_are_pruned_and_replaced_alone(spark, tmp_path):
    path, df = str(tmp_path / "events"), events(spark)
    replace_partitions(df, path, "logday")
    stored = read_partitions(spark, path, df.schema)
    clicks = article_clicks(stored, "20240103", "20240105")
    want = sorted(map(tuple, article_clicks(df, "20240103", "20240105").collect()))
    assert sorted(map(tuple, clicks.collect())) == want and want
    text = plan(clicks)
    filters = text[text.index("PartitionFilters"):].split("]")[0]
    assert "20240103" in filters and "20240105" in filters
    before = files(path)
    replace_partitions(df.where("logday = '20240104'"), path, "logday")
    after = files(path)
    assert {d for d in before if before[d] != after[d]} == {f"{path}/logday=20240104"}
    stored = read_partitions(spark, path, df.schema)
    assert sorted(map(tuple, stored.select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_a_list_of_days_prunes_at_run_time(spark, tmp_path):
    path, df = str(tmp_path / "events"), events(spark)
    replace_partitions(df, path, "logday")
    days = spark.createDataFrame([("20240102", 5), ("20240107", 9), ("20240102", 1)],
                                 "logday string, n int").where("n > 4")
    got = on_days(read_partitions(spark, path, df.schema), days)
    assert "dynamicpruning" in plan(got).lower()
    want = df.where(F.col("logday").isin("20240102", "20240107"))
    assert sorted(map(tuple, got.select(df.columns).collect())) == sorted(map(tuple, want.collect()))


CHANGES = "k string, at long, v string, gone boolean"


def test_folded_snapshot_equals_the_latest_rows(spark, tmp_path):
    rnd = random.Random(7)
    rows = [(f"k{rnd.randrange(25)}", i, f"v{i}", rnd.random() < 0.2) for i in range(300)]
    rnd.shuffle(rows)                      # changes come late and out of order
    path = str(tmp_path / "snapshot")
    schema = spark.createDataFrame([], "k string, at long, v string").schema
    for a in range(0, 300, 100):
        part = spark.createDataFrame(rows[a:a + 100], CHANGES)
        for _ in range(2 if a == 100 else 1):          # one fold is repeated
            fold_changes(part, path, "k", "at", 4, deleted="gone")
        seen = spark.createDataFrame(rows[:a + 100], CHANGES)
        want = latest_snapshot(seen, "k", "at").where("NOT gone").drop("gone")
        got = read_snapshot(spark, path, schema)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    df = spark.createDataFrame([(f"k{i}", 1, "a") for i in range(40)], "k string, at long, v string")
    fold_changes(df, path, "k", "at", 8)
    before = files(path)
    fold_changes(spark.createDataFrame([("k3", 2, "b"), ("k3", 0, "old")], df.schema), path, "k",
                 "at", 8)
    after = files(path)
    assert len(before) > 4 and len({d for d in before if before[d] != after[d]}) == 1
    got = {r.k: r.v for r in read_snapshot(spark, path, df.schema).collect()}
    assert got == {f"k{i}": "b" if i == 3 else "a" for i in range(40)}
    fold_changes(df.limit(0), path, "k", "at", 8)      # no change touches nothing
    assert files(path) == after


def test_a_tombstone_outlasts_an_older_change(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    schema = spark.createDataFrame([], "k string, at long, v string").schema
    for row in (("a", 5, "x", False), ("a", 9, None, True), ("a", 7, "late", None)):
        fold_changes(spark.createDataFrame([row], CHANGES), path, "k", "at", 2, deleted="gone")
        rows = read_snapshot(spark, path, schema).collect()
    assert rows == []
    fold_changes(spark.createDataFrame([("a", 10, "new", False)], CHANGES), path, "k", "at", 2,
                 deleted="gone")
    assert [tuple(r) for r in read_snapshot(spark, path, schema).collect()] == [("a", 10, "new")]


def test_joins_on_stored_buckets_shuffle_neither_side(spark):
    clicks = spark.createDataFrame([(f"u{i % 4}", f"a{i % 9}") for i in range(60)],
                                   "uid string, article_id string")
    kw = spark.createDataFrame([(f"a{i % 11}", f"t{i}", [float(i), 1.0]) for i in range(40)],
                               "article_id string, top_term string, vector array<double>")
    words = spark.createDataFrame([(f"t{i}", [float(i), 1.0]) for i in range(30)],
                                  "word string, vector array<double>")
    save_table(clicks, "bucket_clicks", "parquet", bucket_by="article_id", buckets=4)
    save_table(kw, "bucket_kw", "parquet", bucket_by="article_id", buckets=4)
    save_table(kw.select("article_id", F.col("top_term").alias("term")), "bucket_top", "parquet",
               bucket_by="term", buckets=4)
    save_table(words, "bucket_words", "parquet", bucket_by="word", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        users = user_embedding(spark.table("bucket_clicks"), spark.table("bucket_kw"),
                               preaggregate=False)
        text = plan(users)
        assert "SortMergeJoin" in text and text.count("Exchange") == 1
        assert "Exchange hashpartitioning(uid" in text       # the mean alone
        assert "Exchange" not in plan(document_vectors(spark.table("bucket_kw")))
        met = keyword_vectors(spark.table("bucket_top"), spark.table("bucket_words").hint("merge"),
                              dims=1 << 40)
        assert "Exchange" not in plan(met)
        got = {r.uid: [round(x, 9) for x in r.user_vector] for r in users.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = user_embedding(clicks, kw, preaggregate=False).collect()
    assert got == {r.uid: [round(x, 9) for x in r.user_vector] for r in want}
