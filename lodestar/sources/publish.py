"""R4 / S11 — repeatable parallel publish of a table to an external database.

Rows go to a staging table, one session per partition, in batches of 10,000
rows or of what has come within three seconds, whichever is first.  The live
table is replaced only when the staging table holds every row.

A task may run twice.  Where its batches end depends on time, so a batch is not
known by its number but by the place of its first row: ``(run, partition,
start)``.  The target notes with each batch, in one transaction, how many rows
of the partition it has; an attempt starts there, and a batch from elsewhere is
refused.  The order of a partition's rows must not change between attempts,
which is why the rows are written to the checkpoint folder, sorted, first.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.sources.jdbc import (
    DEFAULT_BATCH_ROWS, bindable, external_ddl, insert_statement,
)
from lodestar.sources.tables import materialize

# Fixed value: seconds after which a batch is sent though it is not full.
DEFAULT_BATCH_SECONDS = 3.0


class Session(Protocol):
    """One partition's connection to the staging table."""

    def position(self) -> int:
        """Rows of this partition that the target has already."""

    def append(self, start: int, rows: Sequence[tuple]) -> None:
        """Add rows ``start…`` of the partition and note the new position, both or neither;
        refuse a ``start`` that is not the position."""

    def close(self) -> None: ...


class Target(Protocol):
    """Where a table is published; sent to the executors, so it holds no connection."""

    def begin(self, schema: T.StructType) -> None: ...

    def session(self, partition: int) -> Session: ...

    def commit(self) -> None: ...

    def abandon(self) -> None: ...


class BatchWriter:
    """Collects rows and appends them when there are ``max_rows`` of them or the first
    of them has waited ``max_seconds``."""

    def __init__(self, session: Session, max_rows: int = DEFAULT_BATCH_ROWS,
                 max_seconds: float = DEFAULT_BATCH_SECONDS,
                 clock: Callable[[], float] = time.monotonic):
        self.session, self.max_rows, self.max_seconds = session, max_rows, max_seconds
        self.clock = clock
        self.skip = self.at = session.position()
        self.rows: list[tuple] = []
        self.since = 0.0
        self.batches = 0

    def write(self, rows: Iterable[tuple]) -> int:
        """All rows of the partition; those that the target has are passed over."""
        seen = 0
        for row in rows:
            seen += 1
            if seen <= self.skip:
                continue
            if not self.rows:
                self.since = self.clock()
            self.rows.append(row)
            if len(self.rows) >= self.max_rows or self.clock() - self.since >= self.max_seconds:
                self.flush()
        self.flush()
        return seen

    def flush(self) -> None:
        if self.rows:
            self.session.append(self.at, self.rows)
            self.at += len(self.rows)
            self.rows = []
            self.batches += 1


class OutOfPlace(RuntimeError):
    """A batch does not begin where the target's rows of that partition end."""


class DbTarget:
    """A table reached through Python's database interface.

    ``connect`` opens a connection (on the driver and in tasks).  Positions are
    kept in ``<table>__progress_<run>``; its row is updated in the transaction of
    the insert and only from the expected position, so of two attempts at one
    batch one fails.  ``swap`` gives the statements that put the staging table in
    the live one's place.
    """

    def __init__(self, connect: Callable[[], object], table: str, run: str, order_by: str = "uid",
                 engine: str = "MergeTree()",
                 swap: Callable[[str, str], list[str]] | None = None):
        self.connect, self.table, self.run = connect, table, run
        self.order_by, self.engine = order_by, engine
        self.staging, self.progress = f"{table}__staging_{run}", f"{table}__progress_{run}"
        self.swap = swap or swap_statements
        self.insert = ""

    def _execute(self, statements: Iterable[str]) -> None:
        connection = self.connect()
        try:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()
        finally:
            connection.close()

    def begin(self, schema: T.StructType) -> None:
        self.insert = insert_statement(schema, self.staging)
        self._execute([
            f"DROP TABLE IF EXISTS {self.staging}", f"DROP TABLE IF EXISTS {self.progress}",
            external_ddl(schema, self.staging, self.order_by, self.engine, nullable=True),
            f"CREATE TABLE {self.progress} (part Int64, rows_done Int64) "
            f"ENGINE = {self.engine} ORDER BY (part)"])

    def session(self, partition: int) -> Session:
        return _DbSession(self, partition)

    def commit(self) -> None:
        self._execute([*self.swap(self.table, self.staging),
                       f"DROP TABLE IF EXISTS {self.progress}"])

    def abandon(self) -> None:
        self._execute([f"DROP TABLE IF EXISTS {self.staging}",
                       f"DROP TABLE IF EXISTS {self.progress}"])


class _DbSession:
    def __init__(self, target: DbTarget, partition: int):
        self.target, self.partition = target, partition
        self.connection = target.connect()

    def position(self) -> int:
        cursor = self.connection.cursor()
        cursor.execute(f"SELECT max(rows_done) FROM {self.target.progress} WHERE part = ?",
                       (self.partition,))
        found = cursor.fetchone()
        if found and found[0] is not None:
            return int(found[0])
        cursor.execute(f"INSERT INTO {self.target.progress} (part, rows_done) VALUES (?, ?)",
                       (self.partition, 0))
        self.connection.commit()
        return 0

    def append(self, start: int, rows: Sequence[tuple]) -> None:
        cursor = self.connection.cursor()
        cursor.execute(f"UPDATE {self.target.progress} SET rows_done = ? "
                       "WHERE part = ? AND rows_done = ?",
                       (start + len(rows), self.partition, start))
        if cursor.rowcount != 1:
            self.connection.rollback()
            raise OutOfPlace(f"{self.target.staging}: partition {self.partition}, row {start}")
        cursor.executemany(self.target.insert, rows)
        self.connection.commit()

    def close(self) -> None:
        self.connection.close()


def swap_statements(table: str, staging: str) -> list[str]:
    """Put ``staging`` in the place of ``table`` (which need not exist); the old one goes."""
    return [f"DROP TABLE IF EXISTS {table}__old", f"CREATE TABLE IF NOT EXISTS {table} AS {staging}",
            f"RENAME TABLE {table} TO {table}__old, {staging} TO {table}",
            f"DROP TABLE {table}__old"]


def publish_batches(df: DataFrame, target: Target, cluster_by: str | None = "uid",
                    max_rows: int = DEFAULT_BATCH_ROWS,
                    max_seconds: float = DEFAULT_BATCH_SECONDS,
                    clock: Callable[[], float] = time.monotonic) -> int:
    """Replace the target's table by ``df``; returns the number of rows.

    Rows are sorted within their partition (by ``cluster_by``, then by every
    other column that has an order) and written to the checkpoint folder, so
    that all attempts of a task see them alike; then each partition is sent
    through a :class:`BatchWriter`.  The live table changes only if the target
    took as many rows as there are; otherwise it stays and an error is raised.
    A table of no rows replaces the live one too.
    """
    rows = bindable(df)
    first = [cluster_by] if cluster_by else []
    rest = [f.name for f in rows.schema.fields if f.name not in first]
    stored = materialize(rows.sortWithinPartitions(*[F.col(f"`{c}`") for c in first + rest]))
    target.begin(rows.schema)

    def send(batches):
        part = TaskContext.get().partitionId()
        session = target.session(part)
        try:
            writer = BatchWriter(session, max_rows, max_seconds, clock)
            sent = writer.write(row for batch in batches
                                for row in zip(*(c.to_pylist() for c in batch.columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([sent]), pa.array([writer.at]), pa.array([writer.batches])],
                names=["seen", "taken", "batches"])
        finally:
            session.close()

    try:
        done = stored.mapInArrow(send, "seen long, taken long, batches long").agg(
            F.sum("seen").alias("seen"), F.sum("taken").alias("taken")).first()
        n = stored.count()
        if (done["seen"] or 0, done["taken"] or 0) != (n, n):
            raise RuntimeError(f"the target has {done['taken']} of {n} rows")
    except Exception:
        target.abandon()
        raise
    target.commit()
    return n
