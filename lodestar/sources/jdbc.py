"""R4 / S11–S15 — typed publish to an external (OLAP) table over JDBC.

The DDL is derived from ``df.schema`` field objects, never by re-parsing a
``"name type"`` string, and integer types are mapped by class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark type -> external column type; anything else -> String.
TYPE_MAP: tuple[tuple[type, str], ...] = (
    (T.StringType, "String"),
    (T.IntegerType, "Int32"),
    (T.LongType, "Int64"),
    (T.FloatType, "Float32"),
    (T.DoubleType, "Float64"),
    (T.DateType, "Date"),
    (T.TimestampType, "DateTime"),
)
DEFAULT_EXTERNAL_TYPE = "String"
# Rows per JDBC batch.
DEFAULT_BATCH_ROWS = 10_000


def external_type(dt: T.DataType, nullable: bool = False) -> str:
    """External column type for a Spark type (``Nullable(...)`` when asked)."""
    name = DEFAULT_EXTERNAL_TYPE
    for cls, ext in TYPE_MAP:
        if isinstance(dt, cls):
            name = ext
            break
    return f"Nullable({name})" if nullable else name


def bindable(df: DataFrame) -> DataFrame:
    """``df`` with every column that is declared as text cast to it (decimals, booleans,
    timestamps without a zone, arrays as JSON …)."""
    known = tuple(kind for kind, _ in TYPE_MAP)

    def bound(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, known):
            return c
        nested = isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
        return (F.to_json(c) if nested else c.cast("string")).alias(f.name)

    return df.select(*[bound(f) for f in df.schema.fields])


def external_columns(schema: T.StructType, nullable: bool = False,
                     key: str | None = None) -> str:
    """``"uid String, age Int32, …"`` in schema order; with ``nullable``, all
    columns that may hold NULL but the ``key`` are declared so."""
    return ", ".join(
        f"{f.name} {external_type(f.dataType, nullable and f.nullable and f.name != key)}"
        for f in schema.fields)


def external_ddl(schema: T.StructType, table: str, order_by: str = "uid",
                 engine: str = "MergeTree()", nullable: bool = False) -> str:
    """``CREATE TABLE`` text for the external table, ordered by ``order_by``."""
    return (f"CREATE TABLE {table} ({external_columns(schema, nullable, order_by)}) "
            f"ENGINE = {engine} ORDER BY ({order_by})")


def insert_statement(schema: T.StructType, table: str) -> str:
    """``INSERT INTO t (a, b) VALUES (?, ?)`` — the statement a batched writer binds."""
    names = ", ".join(f.name for f in schema.fields)
    marks = ", ".join("?" for _ in schema.fields)
    return f"INSERT INTO {table} ({names}) VALUES ({marks})"


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch: int = DEFAULT_BATCH_ROWS,
                 max_connections: int | None = None,
                 extra: dict[str, str] | None = None) -> dict[str, str]:
    """Writer options: one connection per partition, ``batch`` rows per round trip,
    at most ``max_connections`` partitions writing at once."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batch)}
    for key, value in (("user", user), ("password", password), ("driver", driver),
                       ("numPartitions", max_connections)):
        if value is not None:
            opts[key] = str(value)
    opts.update(extra or {})
    return opts


def recreate_external_table(spark: SparkSession, options: dict[str, str],
                            schema: T.StructType, order_by: str = "uid",
                            engine: str = "MergeTree()") -> str:
    """Drop and create the external table from the schema (driver side, two statements).

    Spark's own ``createTableColumnTypes`` only accepts Spark type names, so the
    external types are applied through a plain JDBC statement.
    """
    table = options["dbtable"]
    ddl = external_ddl(schema, table, order_by, engine, nullable=True)
    props = spark._jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            props.setProperty(key, options[key])
    if "driver" in options:
        spark._jvm.java.lang.Class.forName(options["driver"])
    conn = spark._jvm.java.sql.DriverManager.getConnection(options["url"], props)
    try:
        stmt = conn.createStatement()
        if "." in table:
            stmt.execute(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
        stmt.execute(f"DROP TABLE IF EXISTS {table}")
        stmt.execute(ddl)
        stmt.close()
    finally:
        conn.close()
    return ddl


def publish_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
                 password: str | None = None, driver: str | None = None,
                 batch: int = DEFAULT_BATCH_ROWS, cluster_by: str | None = "uid",
                 max_connections: int | None = None, engine: str = "MergeTree()",
                 recreate: bool = True, extra: dict[str, str] | None = None) -> None:
    """Recreate ``table`` and insert ``df`` in parallel batches.

    Spark's JDBC writer opens one connection per partition, binds rows with
    their types (NULLs as SQL NULL) and sends ``batch`` rows per round trip.
    ``max_connections`` caps concurrent connections (Spark coalesces to that
    many partitions first).  Rows are sorted by ``cluster_by`` inside each
    partition, so every batch arrives in key order.
    """
    options = jdbc_options(url, table, user, password, driver, batch, max_connections, extra)
    if recreate:
        recreate_external_table(df.sparkSession, options, df.schema, cluster_by or "tuple()",
                                engine)
    out = df.sortWithinPartitions(cluster_by) if cluster_by else df
    bindable(out).write.format("jdbc").mode("append").options(**options).save()
