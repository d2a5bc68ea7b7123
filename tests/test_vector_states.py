"""Mergeable vector means: zero, reduce, merge, finish, and states stored by day."""

import glob
import os
import random

from pyspark.sql import functions as F

from lodestar.operators import (
    article_clicks, daily_states, finish_states, merge_states, read_states, save_states,
    user_embedding, vector_mean, vector_states,
)

SCHEMA = "k string, logday string, vector array<double>"


def rows(n=60, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice("abc"), f"2024010{rnd.randrange(1, 6)}",
             None if rnd.random() < 0.1 else [float(rnd.randrange(100)) for _ in range(3)])
            for _ in range(n)]


def bag(states):
    # Summarizer holds means and weights, so sums are exact up to rounding
    return sorted((r.k, tuple(round(x, 6) for x in r.sums), r.n) for r in states.collect())


def test_merge_is_associative_and_commutative(spark):
    data = rows()
    parts = [vector_states(spark.createDataFrame(data[i::3], SCHEMA), "k") for i in range(3)]
    a, b, c = parts
    left = merge_states(merge_states(a.union(b), "k").union(c), "k")
    right = merge_states(a.union(merge_states(c.union(b), "k")), "k")
    whole = vector_states(spark.createDataFrame(data, SCHEMA), "k")
    assert bag(left) == bag(right) == bag(whole)
    zero = vector_states(spark.createDataFrame([], SCHEMA), "k")
    assert bag(merge_states(whole.union(zero), "k")) == bag(whole)
    want = {r.k: r.vector for r in vector_mean(spark.createDataFrame(data, SCHEMA), "k").collect()}
    got = {r.k: r.vector for r in finish_states(left, "k").collect()}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k in got for x, y in zip(got[k], want[k]))


def test_a_weight_counts_a_row_that_often(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 3), ("a", [5.0, 0.0], 1), ("b", None, 2)],
                               "k string, vector array<double>, w int")
    assert bag(vector_states(df, "k", weight="w")) == [("a", (8.0, 6.0), 4)]


def test_a_run_replaces_its_days_only(spark, tmp_path):
    path = str(tmp_path / "states")
    first = spark.createDataFrame(rows(), SCHEMA)
    save_states(vector_states(first, ["k", "logday"]), path)
    before = {d: sorted(os.listdir(d)) for d in glob.glob(f"{path}/logday=*")}
    again = first.where("logday = '20240103'")
    save_states(vector_states(again, ["k", "logday"]), path)      # a repeated load
    after = {d: sorted(os.listdir(d)) for d in glob.glob(f"{path}/logday=*")}
    assert {d for d in before if before[d] != after[d]} == {f"{path}/logday=20240103"}
    whole = vector_states(first, "k")
    assert bag(merge_states(read_states(spark, path), "k")) == bag(whole)
    some = read_states(spark, path, "20240102", "20240104")
    assert bag(merge_states(some, "k")) == bag(vector_states(
        first.where("logday BETWEEN '20240102' AND '20240104'"), "k"))
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(logday" in scan


def test_daily_states_add_up_to_the_user_embedding(spark):
    rnd = random.Random(3)
    events = spark.createDataFrame(
        [(f"u{rnd.randrange(4)}", f"a{rnd.randrange(6)}", f"2024010{rnd.randrange(1, 9)}", "AppClick",
          "内容详情页") for _ in range(80)],
        "distinct_id string, article_id string, logday string, event string, element_page string")
    kw = spark.createDataFrame([(f"a{i}", f"t{j}", None if j == 2 else [float(i), float(j)])
                                for i in range(5) for j in range(i + 1)],
                               "article_id string, top_term string, vector array<double>")
    days = ("20240102", "20240107")
    plain = user_embedding(article_clicks(events, *days), kw, preaggregate=False)
    states = daily_states(article_clicks(events, *days, keep_day=True), kw)
    assert states.select("uid", "logday").distinct().count() == states.count()
    got = finish_states(merge_states(states, "uid"), "uid", "user_vector")
    want = {r.uid: r.user_vector for r in plain.collect()}
    got = {r.uid: r.user_vector for r in got.select("uid", F.col("user_vector")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 1e-9 for k in got for x, y in zip(got[k], want[k]))
