"""What a saved step has shuffled goes with it, so that long jobs do not pile it up."""

import time

from pyspark.sql import functions as F

from lodestar.llm import ngram_jaccard
from lodestar.llm._spark import saved
from lodestar.session import SHUFFLE_CLEANUP_CONF, shuffles_freed


def shuffle_files(spark):
    """Names of the session's shuffle files."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager() \
        .diskBlockManager().getAllFiles()
    names = {found.apply(i).getName() for i in range(found.size())}
    return {n for n in names if n.startswith("shuffle_")}


def left_by(spark, run):
    """Shuffle files of ``run`` that are still there some seconds after it."""
    before = shuffle_files(spark)
    held = run()        # not garbage while the files are counted
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    del held
    return left


def test_saved_leaves_no_shuffle_files(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert not left_by(spark, lambda: (df, saved(df)))
    assert saved(df).count() == 7 and df.count() == 7       # and the frame can be run again


def test_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    with shuffles_freed(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == before


def test_near_stage_leaves_little_and_does_not_shuffle_texts(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*words, f"only{i}"])) for i in range(6)] \
        + [(i, " ".join(f"x{i}y{j}" for j in range(20))) for i in range(6, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = []
    left = left_by(spark, lambda: held.append(ngram_jaccard.keep_one_of_each(docs)) or held)
    # only counts of single rows (limits, first rows) are run without being saved
    assert len({n.split("_")[1] for n in left}) < 12
    plan = held[0]._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "BroadcastHashJoin" in plan
    assert sorted(r["doc_id"] for r in held[0].collect()) == [0, *range(6, 20)]
