"""What near-duplicate detection costs the driver: rarity table, rounds of components."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import _spark, ngram_jaccard


def least(links):
    label = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    return label


def linked(spark, links):
    return spark.createDataFrame(links, "a long, b long").repartition(3)


@pytest.mark.parametrize("at_once", [_spark.LINKS_AT_ONCE, 40])
def test_components_whatever_a_task_contracts(spark, at_once):
    rnd = random.Random(at_once)
    path = [(-i, -i - 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(40)]
    loose = [(rnd.randrange(2000, 2120), rnd.randrange(2000, 2120)) for _ in range(60)]
    links = path + star + loose + path[:5]
    rows = linked(spark, [*links, (7, 7), (None, 3), (4, None)])
    got = {r["node"]: r["label"] for r in
           _spark.connected_components(rows, at_once=at_once).collect()}
    assert got == least([(a, b) for a, b in links if a != b])


def test_few_links_take_few_jobs(spark):
    """Each star round is some ten exchanges, whose threads and code the driver holds."""
    links = linked(spark, [(i, i + 1) for i in range(200)])
    context = spark.sparkContext
    context.setJobGroup("components", "components")
    try:
        _spark.connected_components(links)
        assert len(context.statusTracker().getJobIdsForGroup("components")) <= 12
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_no_links(spark):
    assert _spark.connected_components(linked(spark, [(1, 1)])).count() == 0


def test_rarity_table_is_one_byte_a_bucket(spark):
    docs = spark.createDataFrame(
        [(i, "one two three four five" if i % 2 else f"a{i} b c d e") for i in range(40)],
        "doc_id long, text string").repartition(3)
    tallies = (docs.transform(_spark.in_tasks, lambda it: ngram_jaccard._describe(it, 5, []),
                              "doc_id long, n_shingles long, cls long, check long, tally binary")
               .where("tally IS NOT NULL").select(F.col("n_shingles").alias("part"), "tally"))
    levels = ngram_jaccard.rarity(tallies)
    assert levels.nbytes == ngram_jaccard.BUCKETS
    assert sorted(levels[levels > 0].tolist()) == [1] * 20 + [20]
    many = ngram_jaccard.rarity_levels(np.array([0, 5, 127, 128, 1000, 10**6, 2**40]))
    assert many.tolist()[:4] == [0, 5, 127, 128] and (np.diff(many.astype(int)) > 0).all()
