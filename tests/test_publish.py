"""publish_jdbc's writer path, recorded through a fake writer (no database is started)."""

from pyspark.sql import readwriter

import lodestar.sources.jdbc as jdbc


def test_publish_jdbc_recreates_and_appends_sorted(spark, monkeypatch):
    calls = {}

    def fake_recreate(spark_, options, schema, order_by, engine):
        calls["ddl"] = jdbc.external_ddl(schema, options["dbtable"], order_by, engine)
        return calls["ddl"]

    def rec(name):
        def method(self, *args, **kwargs):
            calls.setdefault(name, []).append((args, kwargs))
            return self
        return method

    monkeypatch.setattr(jdbc, "recreate_external_table", fake_recreate)
    for name in ("format", "mode", "options"):
        monkeypatch.setattr(readwriter.DataFrameWriter, name, rec(name))
    monkeypatch.setattr(readwriter.DataFrameWriter, "save", rec("save"))

    df = spark.createDataFrame([("b", 2), ("a", None)], "uid string, age int")
    seen = {}
    original = df.sortWithinPartitions

    def spy(*cols):
        seen["cols"] = cols
        return original(*cols)

    monkeypatch.setattr(df, "sortWithinPartitions", spy)
    jdbc.publish_jdbc(df, "jdbc:fake://h/db", "app.profile", user="u", max_connections=4)
    assert calls["ddl"] == ("CREATE TABLE app.profile (uid String, age Int32) "
                            "ENGINE = MergeTree() ORDER BY (uid)")
    assert calls["format"][0][0] == ("jdbc",) and calls["mode"][0][0] == ("append",)
    assert calls["options"][0][1] == {"url": "jdbc:fake://h/db", "dbtable": "app.profile",
                                      "batchsize": "10000", "user": "u", "numPartitions": "4"}
    assert len(calls["save"]) == 1 and seen["cols"] == ("uid",)


def test_external_ddl_declares_nullable_columns(spark):
    schema = spark.createDataFrame([], "uid string, age int").schema
    assert jdbc.external_ddl(schema, "app.t", "uid", nullable=True) == (
        "CREATE TABLE app.t (uid String, age Nullable(Int32)) ENGINE = MergeTree() ORDER BY (uid)")
