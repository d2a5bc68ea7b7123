import datetime as dt
import decimal
import os
import tempfile

import pytest
from pyspark.sql import types as T

from lodestar.sources import (
    create_table_if_not_exists, external_columns, external_ddl, external_type,
    insert_statement, jdbc_options, read_dictionary, read_word_list, save_table,
    write_all,
)

SINK_SCHEMA = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("l", T.LongType()),
    T.StructField("f", T.FloatType()), T.StructField("d", T.DoubleType()),
    T.StructField("s", T.StringType()), T.StructField("dt", T.DateType()),
    T.StructField("ts", T.TimestampType()), T.StructField("dec", T.DecimalType(10, 2)),
])
SINK_ROWS = [
    (1, 2, 1.5, 2.5, "x", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5),
     decimal.Decimal("12.34")),
    (None, None, None, None, None, None, None, None),
]


def test_external_type_map():
    assert [external_type(f.dataType) for f in SINK_SCHEMA.fields] == [
        "Int32", "Int64", "Float32", "Float64", "String", "Date", "DateTime", "String"]
    assert external_type(T.IntegerType(), nullable=True) == "Nullable(Int32)"


def test_ddl_and_insert_text():
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ["uid", "gender", "age", "region", "email_suffix", "model"]])
    assert external_columns(schema) == ("uid String, gender String, age String, region String, "
                                        "email_suffix String, model String")
    assert external_ddl(schema, "app.user_profile_base") == (
        "CREATE TABLE app.user_profile_base (uid String, gender String, age String, "
        "region String, email_suffix String, model String) ENGINE = MergeTree() ORDER BY (uid)")
    assert insert_statement(schema, "t") == (
        "INSERT INTO t (uid, gender, age, region, email_suffix, model) "
        "VALUES (?, ?, ?, ?, ?, ?)")


def test_jdbc_options():
    o = jdbc_options("jdbc:x://h/db", "t", user="u", password="p", max_connections=16)
    assert o == {"url": "jdbc:x://h/db", "dbtable": "t", "batchsize": "10000", "user": "u",
                 "password": "p", "numPartitions": "16"}


def test_typed_round_trip_orc_and_parquet_with_nulls(spark):
    df = spark.createDataFrame(SINK_ROWS, SINK_SCHEMA)
    for fmt, name in (("orc", "sink_orc"), ("parquet", "sink_parquet")):
        save_table(df, name, fmt=fmt)
        back = spark.table(name)
        assert back.schema == SINK_SCHEMA
        assert sorted(back.collect(), key=lambda r: r.i is None) == \
            sorted(df.collect(), key=lambda r: r.i is None)


def test_create_if_not_exists_then_overwrite_and_write_all(spark):
    schema = T.StructType([T.StructField("uid", T.StringType())])
    create_table_if_not_exists(spark, "profile_t", schema)
    create_table_if_not_exists(spark, "profile_t", schema)   # idempotent
    df = spark.createDataFrame([("a",), ("b",)], schema)
    write_all(df, [lambda d: save_table(d, "profile_t", fmt="parquet"),
                   lambda d: save_table(d, "profile_copy", fmt="orc")])
    assert spark.table("profile_t").count() == 2 and spark.table("profile_copy").count() == 2


def test_read_word_list_with_fallback(spark):
    folder = tempfile.mkdtemp(prefix="lodestar-words-")
    path = os.path.join(folder, "dict.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("经济 n 100 vn 3\n人工智能\n\n技术 n\n")
    got = {r.word: r.pos for r in read_word_list(spark, path, default_pos="nz").collect()}
    assert got == {"经济": "n", "人工智能": "nz", "技术": "n"}
    fb = read_word_list(spark, os.path.join(folder, "missing.txt"), "nz", fallback=path)
    assert fb.count() == 3


def test_read_dictionary_priority_and_defaults(spark):
    folder = tempfile.mkdtemp(prefix="lodestar-dicts-")
    first, second = os.path.join(folder, "custom.txt"), os.path.join(folder, "places.txt")
    with open(first, "w", encoding="utf-8") as fh:
        fh.write("上海 ns\n浦东\n")
    with open(second, "w", encoding="utf-8") as fh:
        fh.write("上海 nr\n北京\n")
    d = {r.word: r.pos for r in read_dictionary(spark, [(first, "nz"), (second, "ns")]).collect()}
    assert d == {"上海": "ns", "浦东": "nz", "北京": "ns"}


def test_rows_are_counted_by_their_write(spark):
    from lodestar.sources import save_counted

    df = spark.range(37).selectExpr("id", "id % 3 AS part")
    assert save_counted(df, "counted_orc") == spark.table("counted_orc").count() == 37
    assert save_counted(df.where("id < 0"), "counted_parquet", "parquet") == 0
    assert spark.table("counted_parquet").count() == 0


def test_word_list_frequencies_and_other_failures(spark):
    folder = tempfile.mkdtemp(prefix="lodestar-words-")
    path = os.path.join(folder, "dict.txt")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("经济 n 100 vn 3\n人工智能\n技术 n x\n")
    got = {r.word: r.freq for r in read_word_list(spark, path).collect()}
    assert got == {"经济": 103, "人工智能": None, "技术": None}
    with pytest.raises(Exception):         # no such file system: not a missing file
        read_word_list(spark, "nowhere://x/dict.txt", fallback=path).collect()


def test_stored_rows_are_read_by_column(spark):
    from lodestar.sources.tables import stored

    df = stored(spark.createDataFrame([("a", 1, [1.0]), (None, 2, None)], "s string, n int, v array<double>"))
    assert sorted(df.select("n").collect()) == [(1,), (2,)] and df.where("s IS NULL").count() == 1
    plan = df.select("n")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n:int>" in plan
    assert stored(df.limit(0)).collect() == []
