import math

import pytest
from pyspark.sql import functions as F

from lodestar.operators import (
    document_frequency, global_top_n, hashing_tf, term_frequency, tfidf, top_keywords,
    top_terms_table,
)


def _terms(spark, docs):
    rows = [(a, i, t) for a, ts in docs for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "article_id string, pos int, term string")


FIXTURE = [("1", ["apple", "zeta", "mid"]), ("2", ["zeta", "apple"]),
           ("3", ["zeta", "rare", "apple2"])]


def test_idf_values(spark):
    s = {(r.article_id, r.term): r.score for r in tfidf(_terms(spark, FIXTURE)).collect()}
    assert s[("1", "zeta")] == pytest.approx(0.0)
    assert s[("1", "apple")] == pytest.approx(0.287682, abs=1e-6)
    assert s[("1", "mid")] == pytest.approx(0.693147, abs=1e-6)
    assert s[("3", "rare")] == pytest.approx(math.log(4 / 2))


def test_top1_desc_and_asc(spark):
    scored = tfidf(_terms(spark, FIXTURE))
    desc = {r.article_id: r.term for r in top_keywords(scored, 1).collect()}
    assert desc == {"1": "mid", "2": "apple", "3": "apple2"}
    asc = {r.article_id: r.term for r in top_keywords(scored, 1, order="asc").collect()}
    assert asc == {"1": "zeta", "2": "zeta", "3": "zeta"}


def test_top_terms_table_in_rank_and_text_order(spark):
    t = _terms(spark, FIXTURE)
    out = {r.article_id: (r.top_terms, r.terms)
           for r in top_terms_table(top_keywords(tfidf(t), 2), t).collect()}
    assert out["1"] == ("mid,apple", "apple,zeta,mid")


def test_matches_mllib_countvectorizer_idf(spark):
    from pyspark.ml.feature import IDF, CountVectorizer
    docs = [(str(i), sorted({f"w{(i * j) % 17}" for j in range(1, 9)})) for i in range(40)]
    arr = spark.createDataFrame(docs, "article_id string, terms array<string>")
    cv = CountVectorizer(inputCol="terms", outputCol="tf").fit(arr)
    feats = IDF(inputCol="tf", outputCol="x").fit(cv.transform(arr)).transform(cv.transform(arr))
    vocab = cv.vocabulary
    want = {}
    for r in feats.collect():
        for idx, val in zip(r.x.indices, r.x.values):
            want[(r.article_id, vocab[idx])] = val
    got = {(r.article_id, r.term): r.score for r in tfidf(_terms(spark, docs)).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_vocabulary_cap_matches_sorted_limit(spark):
    docs = [(str(i), [f"t{j}" for j in range(i % 13 + 1)] + [f"u{i}"]) for i in range(60)]
    tf = term_frequency(_terms(spark, docs))
    for cap in (1, 5, 14, 500):
        got = [(r.term, r.cnt) for r in
               document_frequency(tf, cap).orderBy(F.desc("cnt"), "term").collect()]
        want = [(r.term, r.cnt) for r in
                tf.groupBy("term").agg(F.sum("tf").alias("cnt"))
                .orderBy(F.desc("cnt"), "term").limit(cap).collect()]
        assert got == want


def test_global_top_n_ranks(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"),
                                  ((F.col("id") * 7919) % 1000).alias("k")).repartition(7)
    got = global_top_n(df, "k", "id", 25, rank_col="rank")
    rows = sorted((r["rank"], r.k) for r in got.collect())
    assert rows == [(i + 1, 999 - i) for i in range(25)]


def test_min_df_fraction(spark):
    t = _terms(spark, FIXTURE)
    from lodestar.operators.keywords import document_count
    v = document_frequency(term_frequency(t), None, 0.5, document_count(t))
    assert sorted(r.term for r in v.collect()) == ["apple", "zeta"]


def test_hashing_tf_matches_mllib(spark):
    from pyspark.ml.feature import HashingTF
    docs = [("1", ["apple", "zeta", "mid"]), ("2", ["中文", "zeta"])]
    arr = spark.createDataFrame(docs, "article_id string, terms array<string>")
    h = HashingTF(inputCol="terms", outputCol="v", numFeatures=512).transform(arr)
    want = {(r.article_id, int(i)): v for r in h.collect()
            for i, v in zip(r.v.indices, r.v.values)}
    got = {(r.article_id, r.bucket): float(r.tf) for r in hashing_tf(arr, 512).collect()}
    assert got == want


def test_keyword_invariants(spark):
    docs = [(str(i), list(dict.fromkeys(f"w{(i + j * j) % 23}" for j in range(12))))
            for i in range(30)]
    t = _terms(spark, docs)
    top = top_keywords(tfidf(t), 5).collect()
    per = {}
    for r in top:
        per.setdefault(r.article_id, []).append(r.term)
    src = dict(docs)
    for a, ks in per.items():
        assert len(ks) <= 5 and len(set(ks)) == len(ks) and set(ks) <= set(src[a])


def test_non_distinct_terms_count_real_tf(spark):
    docs = [("1", ["a", "b", "a", "a"]), ("2", ["b", "c"])]
    s = {(r.article_id, r.term): (r.tf, r.df) for r in
         tfidf(_terms(spark, docs)).collect()}
    assert s[("1", "a")] == (3, 1) and s[("1", "b")] == (1, 2) and s[("2", "c")] == (1, 1)


def test_k_larger_than_terms_keeps_all(spark):
    top = top_keywords(tfidf(_terms(spark, FIXTURE)), 100).collect()
    assert len(top) == sum(len(t) for _, t in FIXTURE)
    ranks = sorted(r["rank"] for r in top if r.article_id == "1")
    assert ranks == [1, 2, 3]


def test_global_top_n_with_ties_is_total_order(spark):
    df = spark.range(300).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("id"),
                                 (F.col("id") % 3).alias("k")).repartition(9)
    got = global_top_n(df, "k", "id", 101, rank_col="rank")
    rows = sorted((r["rank"], r.k, int(r.id)) for r in got.collect())
    assert [(k, i) for _, k, i in rows] == [(2, i) for i in range(2, 300, 3)] + [(1, 1)]


def test_global_top_n_cuts_at_any_place(spark):
    import random

    rnd = random.Random(4)
    rows = [("".join(rnd.choice("abé") for _ in range(rnd.randrange(5))) + f"{i}",
             rnd.choice([0, 1, 1, 1, 2, 4095, 4096, 4100, 70_000, 70_001, 2**40, 2**62]))
            for i in range(400)]
    df = spark.createDataFrame(rows + [("none", None), (None, 5)], "w string, c long").repartition(5)
    best = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
    for n in (0, 1, 30, 60, 100, 177, 399, 400, 5000):
        got = [tuple(r) for r in global_top_n(df, "c", "w", n).collect()]
        assert sorted(got) == sorted(best[:n])
    assert global_top_n(df.limit(0), "c", "w", 3).collect() == []


def test_global_top_n_neither_sorts_the_table_nor_runs_a_job(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("w"), "id")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan only", "plan only")
    top = global_top_n(df, "id", "w", 10)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert list(status.getJobIdsForGroup("plan only")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "rangepartitioning" not in plan and "ExistingRDD" not in plan


def test_hashing_tf_takes_any_number_of_buckets(spark):
    arr = spark.createDataFrame([("a", ["x", "y", "x"])], "article_id string, terms array<string>")
    got = hashing_tf(arr, 1 << 20).collect()
    assert sorted(r.tf for r in got) == [1, 2] and all(r.bucket < 1 << 20 for r in got)


def test_df_counts_articles_once(spark):
    rows = [("a", 0, "x"), ("a", 1, "x"), ("b", 0, "x"), ("b", 1, "y")]
    got = {(r.article_id, r.term): (r.tf, r.df) for r in tfidf(
        spark.createDataFrame(rows, "article_id string, pos int, term string")).collect()}
    assert got == {("a", "x"): (2, 2), ("b", "x"): (1, 2), ("b", "y"): (1, 1)}


def test_rows_of_terms_are_counted_once_and_not_shuffled_for_the_join(spark):
    t = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", None)],
                              "article_id string, term string")
    scored = tfidf(t)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    # the counts are read from the stored table; the vocabulary's measured size allows a broadcast
    assert "strategy=broadcast" in plan and "Aggregate" not in plan and plan.count("parquet") == 2
    assert sorted((r.article_id, r.term, r.tf, r.df) for r in scored.collect()) == [
        ("a", "x", 2, 2), ("a", "y", 1, 1), ("b", "x", 1, 2)]
