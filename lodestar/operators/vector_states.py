"""A2 — a vector mean as mergeable states, so that a new day never re-reads old ones.

A state is ``(keys…, sums array<double>, n long)``: what the rows so far add up to.
The four steps of such an aggregate are DataFrame operations:

* *zero* is no row at all;
* *reduce* (:func:`vector_states`) turns rows into states;
* *merge* (:func:`merge_states`) adds states of the same key, in any order and any
  grouping;
* *finish* (:func:`finish_states`) divides.

States are stored by day (:func:`save_states`): a run replaces exactly the days
that it holds, so it can be repeated, and the mean over any range of days is a
merge of its stored states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.vectors import to_array, to_vector
from lodestar.sources.tables import replace_partitions


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def vector_states(df: DataFrame, keys: Sequence[str] | str, col: str = "vector",
                  weight: str | None = None) -> DataFrame:
    """States of the vectors in ``col`` (NULL vectors are skipped); with ``weight`` a row
    counts that often."""
    keys = _keys(keys)
    vector = to_vector(col)
    if weight is None:
        sums, n = Summarizer.sum(vector), F.count(F.lit(1))
    else:
        sums, n = Summarizer.sum(vector, F.col(weight).cast("double")), F.sum(weight)
    return (df.where(F.col(col).isNotNull()).groupBy(*keys)
            .agg(sums.alias("_sums"), n.cast("long").alias("n"))
            .select(*keys, to_array("_sums").alias("sums"), "n"))


def merge_states(states: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """One state per key.  Adds on the map side first: a key with a state from every
    day and task is one row a partition before the shuffle."""
    keys = _keys(keys)
    return (states.groupBy(*keys)
            .agg(Summarizer.sum(to_vector("sums")).alias("_sums"), F.sum("n").alias("n"))
            .select(*keys, to_array("_sums").alias("sums"), "n"))


def finish_states(states: DataFrame, keys: Sequence[str] | str, out: str = "vector") -> DataFrame:
    """The mean vector of every state; a state of no rows has none."""
    return states.where(F.col("n") > 0).select(
        *_keys(keys), F.transform("sums", lambda x: x / F.col("n")).alias(out))


def save_states(states: DataFrame, path: str, day_col: str = "logday") -> None:
    """Write states into a Parquet table partitioned by day, replacing the days that
    ``states`` holds and no other (dynamic partition overwrite)."""
    replace_partitions(states, path, day_col)


def read_states(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                day_col: str = "logday") -> DataFrame:
    """Stored states of the days ``start`` to ``end`` (inclusive); other days' files are
    not read."""
    states = spark.read.option("basePath", path).parquet(path)
    states = states.withColumn(day_col, F.col(day_col).cast("string"))
    day = F.col(day_col)
    if start is not None:
        states = states.where(day >= start)
    return states if end is None else states.where(day <= end)
