"""What tables and their shuffles take: small forms, deleted when done, the same rows."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_shuffle_files import left_by

from lodestar.operators.joins import fits_broadcast
from lodestar.operators.keywords import top_terms_table
from lodestar.operators.segment import _packed, _unpacked
from lodestar.operators.terms import terms_from_rest
from lodestar.plans import registry
from lodestar.sources.tables import materialize, replace_partitions, save_table, stored


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    df = spark.range(500).groupBy((F.col("id") % 7).alias("k")).agg(F.count("id").alias("n"))
    name = "disk_writes"
    for run in (lambda: stored(df), lambda: materialize(df), lambda: fits_broadcast(df),
                lambda: save_table(df, name, "orc"),
                lambda: replace_partitions(df, str(tmp_path / "t"), "k")):
        assert not left_by(spark, run)
    assert spark.table(name).count() == 7
    spark.sql(f"DROP TABLE {name}")


def test_stored_vectors_are_compact(spark):
    """Vectors of a few hundred words in any order take far less than their numbers."""
    vector = F.transform(F.sequence(F.lit(1), F.lit(64)),
                         lambda i: F.rand(3).cast("float").cast("double") + i)
    words = materialize(spark.range(400).select(F.col("id").alias("word"), vector.alias("vector")))
    rows = spark.range(20_000).select((F.xxhash64("id") % 400).alias("w")).select(
        F.pmod("w", F.lit(400)).alias("word")).join(words, "word")
    table = stored(rows.coalesce(1))
    files = [f.removeprefix("file://").removeprefix("file:") for f in table.inputFiles()]
    kinds = {c.compression for f in files for g in [pq.ParquetFile(f).metadata]
             for i in range(g.num_row_groups)
             for c in [g.row_group(i).column(j) for j in range(g.num_columns)]}
    assert kinds == {"ZSTD"}
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 20_000 == table.count()


def test_dealt_table_is_not_shuffled_again(spark, monkeypatch):
    """The bucketed query shuffles keywords, not their vectors."""
    seen = []
    original = registry.save_table

    def watched(df, name, *args, **kwargs):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString(), kwargs))
        original(df, name, *args, **kwargs)

    monkeypatch.setattr(registry, "save_table", watched)
    d = "/root/testdata/sf0.001"
    registry.QUERIES["user_embedding_bucketed"](spark, d)
    (name, plan, kwargs), = [s for s in seen if s[0].endswith("article_top_terms_w2v")]
    assert kwargs["dealt"]
    # nothing that has a vector is exchanged above the join
    assert "Exchange" not in plan.split("BroadcastHashJoin")[0]
    files = glob.glob(spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'")
                      .first()["data_type"].removeprefix("file:") + "/*.parquet")
    assert 0 < len(files) <= registry.ARTICLE_BUCKETS       # a bucket is one file


def test_lists_at_rest_are_grouped_as_the_terms_are(spark):
    """Several rows of an article, empty terms, an empty and a missing list."""
    rows = [("a", "x,y,,z"), ("a", "q,b"), ("b", ",,w"), ("c", ""), ("d", None), ("e", "x,x"), (None, "n")]
    rest = spark.createDataFrame(rows, "article_id string, content_terms string")
    long = terms_from_rest(rest)
    top = long.groupBy("article_id").agg(F.min("term").alias("term")).withColumn("rank", F.lit(1))
    for as_string in (True, False):
        got, want = (sorted(map(str, top_terms_table(top, t, as_string).collect()))
                     for t in (rest, long))
        assert got == want and len(got) == 3
    arrays = rest.withColumn("content_terms", F.split("content_terms", ","))
    assert sorted(map(str, top_terms_table(top, arrays).collect())) == sorted(
        map(str, top_terms_table(top, long).collect()))


def test_packed_lists_come_back(spark):
    import pyarrow as pa

    lists = pa.RecordBatch.from_pylist(
        [{"article_id": "a", "ats": [0, 3, 1 << 40], "terms": ["x", "人民", ""]},
         {"article_id": None, "ats": [7], "terms": ["𠀀y"]}],
        schema=pa.schema([("article_id", pa.string()), ("ats", pa.list_(pa.int64())),
                          ("terms", pa.list_(pa.string()))]))
    assert _unpacked(_packed(lists)).to_pylist() == lists.to_pylist()
    assert _packed(lists.slice(0, 0)).num_rows == 0


def test_daily_states_leave_no_vectors_in_shuffle_files(spark):
    """Two loads of states: what they shuffled is gone when the query is handed over."""
    held = []
    left = left_by(spark, lambda: held.append(
        registry.QUERIES["user_embedding_daily"](spark, "/root/testdata/sf0.001")) or held)
    # scalar subqueries and lengths, which run without being saved, are not of vectors
    assert len({n.split("_")[1] for n in left}) < 10
    assert held[0].count() > 0
