"""publish_batches through a recording target kept in files (no database is started)."""

import json
import os
import sys
from decimal import Decimal

import pytest
from pyspark import cloudpickle

from lodestar.sources import BatchWriter, DbTarget, bindable, publish_batches
from lodestar.sources.publish import OutOfPlace, swap_statements


# tasks get the classes of this file with the function, as they cannot import it
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Files:
    """A target whose staging table is a file for each partition."""

    def __init__(self, folder, fail_after=None, lose=False):
        self.folder, self.fail_after, self.lose = str(folder), fail_after, lose

    def _log(self, what):
        with open(f"{self.folder}/log", "a") as f:
            f.write(what + "\n")

    def log(self):
        with open(f"{self.folder}/log") as f:
            return f.read().split()

    def begin(self, schema):
        self._log("begin")

    def session(self, partition):
        return FileSession(self, partition)

    def commit(self):
        self._log("commit")

    def abandon(self):
        self._log("abandon")

    def rows(self):
        out = []
        for name in sorted(os.listdir(self.folder)):
            if name.startswith("part-"):
                with open(f"{self.folder}/{name}") as f:
                    out += [tuple(r) for line in f for r in json.loads(line)]
        return out


class FileSession:
    def __init__(self, target, partition):
        self.target, self.path = target, f"{target.folder}/part-{partition:03d}"

    def position(self):
        if not os.path.exists(self.path):
            return 0
        with open(self.path) as f:
            return sum(len(json.loads(line)) for line in f)

    def append(self, start, rows):
        if start != self.position():
            raise OutOfPlace(self.path)
        if self.target.lose and start:
            return
        with open(self.path, "a") as f:
            f.write(json.dumps(rows) + "\n")
        if self.target.fail_after is not None and start >= self.target.fail_after:
            raise ConnectionError("the connection was lost after the rows were taken")

    def close(self):
        pass


class Session:
    def __init__(self, position=0):
        self.at, self.batches = position, []

    def position(self):
        return self.at

    def append(self, start, rows):
        assert start == self.at
        self.at += len(rows)
        self.batches.append(len(rows))


def test_a_batch_ends_when_full_or_when_three_seconds_are_over():
    times = iter([0.0, 0.1, 0.2, 10.0, 10.1, 13.5, 20.0, 20.1])
    session = Session()
    writer = BatchWriter(session, max_rows=3, clock=lambda: next(times))
    # the first batch fills up; the second is sent late, at its second row; the last by the end
    assert writer.write([(i,) for i in range(6)]) == 6
    assert session.batches == [3, 2, 1]


def test_a_second_attempt_sends_what_is_missing():
    session = Session(position=5)
    writer = BatchWriter(session, max_rows=4, max_seconds=1e9)
    assert writer.write([(i,) for i in range(12)]) == 12
    assert session.batches == [4, 3] and writer.at == 12
    late = Session(position=12)
    assert BatchWriter(late).write([(i,) for i in range(12)]) == 12 and late.batches == []


def profile(spark, n=50):
    return spark.createDataFrame([(f"u{i * 7 % n:02d}", i) for i in range(n)],
                                 "uid string, age int").repartition(3)


def test_all_rows_arrive_sorted_and_the_table_is_swapped_last(spark, tmp_path):
    target = Files(tmp_path)
    assert publish_batches(profile(spark), target, max_rows=4) == 50
    assert sorted(target.rows()) == sorted((r.uid, r.age) for r in profile(spark).collect())
    assert target.log() == ["begin", "commit"]
    for name in os.listdir(tmp_path):
        if name.startswith("part-"):
            with open(tmp_path / name) as f:
                batches = [json.loads(line) for line in f]
            rows = [tuple(r) for b in batches for r in b]
            assert rows == sorted(rows) and all(len(b) == 4 for b in batches[:-1])


def test_a_run_after_a_failure_repeats_no_row(spark, tmp_path):
    df = profile(spark).coalesce(1)
    broken = Files(tmp_path, fail_after=8)
    with pytest.raises(Exception, match="connection was lost"):
        publish_batches(df, broken, max_rows=4)
    assert broken.log() == ["begin", "abandon"] and len(broken.rows()) == 12
    assert publish_batches(df, Files(tmp_path), max_rows=5) == 50      # the attempt that goes on
    rows = Files(tmp_path).rows()
    assert len(rows) == 50 and sorted(rows) == sorted((r.uid, r.age) for r in df.collect())


def test_the_live_table_stays_if_rows_are_missing(spark, tmp_path):
    target = Files(tmp_path, lose=True)
    with pytest.raises(Exception):
        publish_batches(profile(spark), target, max_rows=4)
    assert target.log()[-1] == "abandon" and "commit" not in target.log()


def test_an_empty_table_replaces_the_live_one(spark, tmp_path):
    target = Files(tmp_path)
    assert publish_batches(profile(spark).limit(0), target) == 0
    assert target.rows() == [] and target.log() == ["begin", "commit"]


def test_columns_are_bound_as_they_are_declared(spark):
    df = spark.createDataFrame([("a", Decimal("1.50"), True, [1, 2]), ("b", None, None, None)],
                               "uid string, price decimal(10,2), ok boolean, tags array<int>")
    df = df.selectExpr("*", "timestamp_ntz'2024-01-02 03:04:05' AS at", "1L AS n")
    out = bindable(df)
    assert dict(out.dtypes) == {"uid": "string", "price": "string", "ok": "string",
                                "tags": "string", "at": "string", "n": "bigint"}
    assert sorted(tuple(r) for r in out.collect())[0] == (
        "a", "1.50", "true", "[1,2]", "2024-01-02 03:04:05", 1)


class Connection:
    """Records statements; positions are kept as the progress table would."""

    def __init__(self, log, progress):
        self.log, self.progress, self.rowcount, self.found = log, progress, -1, None

    def cursor(self):
        return self

    def execute(self, sql, args=()):
        self.log.append(sql)
        if sql.startswith("SELECT max"):
            self.found = (self.progress.get(args[0]),)
        elif sql.startswith("INSERT INTO t__progress"):
            self.progress[args[0]] = args[1]
        elif sql.startswith("UPDATE"):
            self.rowcount = int(self.progress.get(args[1]) == args[2])
            if self.rowcount:
                self.progress[args[1]] = args[0]

    def executemany(self, sql, rows):
        self.log.append((sql, len(rows)))

    def fetchone(self):
        return self.found

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        pass


def test_statements_of_a_database_target(spark):
    log, progress = [], {}
    target = DbTarget(lambda: Connection(log, progress), "t", "r1")
    target.begin(profile(spark).schema)
    assert log[2] == ("CREATE TABLE t__staging_r1 (uid String, age Nullable(Int32)) "
                      "ENGINE = MergeTree() ORDER BY (uid)")
    one, other = target.session(4), target.session(4)
    assert one.position() == other.position() == 0
    one.append(0, [("a", 1), ("b", 2)])
    assert log[-2:] == [("INSERT INTO t__staging_r1 (uid, age) VALUES (?, ?)", 2), "commit"]
    with pytest.raises(OutOfPlace):            # a second attempt at the same rows
        other.append(0, [("a", 1)])
    assert log[-1] == "rollback" and target.session(4).position() == 2
    target.commit()
    assert log[-6:-2] == swap_statements("t", "t__staging_r1")
