"""Broadcasts are decided by measured rows and bytes."""

from pyspark.sql import functions as F

from lodestar.operators.joins import bounded_broadcast, fits_broadcast


def test_few_very_long_words_do_not_fit(spark):
    words = spark.range(4).select(F.repeat(F.lit("x"), 1_000_000).alias("word"))
    assert fits_broadcast(words, max_rows=10)
    assert not fits_broadcast(words, max_rows=10, max_bytes=1 << 20)
    assert "broadcast" not in bounded_broadcast(
        words, max_bytes=1 << 20)._jdf.queryExecution().logical().toString().lower()


def test_rows_arrays_and_nulls_are_measured(spark):
    vectors = spark.createDataFrame([(1, [0.5] * 1000), (2, None)], "id int, v array<double>")
    assert not fits_broadcast(vectors, max_rows=1)
    assert not fits_broadcast(vectors, max_bytes=8000)
    assert fits_broadcast(vectors, max_bytes=9000)
    assert fits_broadcast(vectors.limit(0), max_rows=0, max_bytes=0)
    nested = spark.createDataFrame([({"k": "x" * 5000},)], "m map<string,string>")
    assert not fits_broadcast(nested, max_bytes=4000)
