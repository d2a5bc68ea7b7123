"""op13 holds one stretch or one slab and few queries at a time."""

import os
import sys

import numpy as np
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from lodestar.llm import prefix_forest as forest  # noqa: E402
from lodestar.llm._blocks import unsqueeze  # noqa: E402


def test_lists_leave_a_task_bit_by_bit(monkeypatch):
    monkeypatch.setattr(forest, "LISTS_AT_ONCE", 10)
    n, asks = 50, 40        # each query asks for all entries, in slabs of 20
    strings = forest.signed(np.arange(n, dtype=np.uint64))
    low, high = (forest.signed(np.array([v], np.uint64))[0] for v in (0, n))
    batch = pa.RecordBatch.from_pydict({
        "pid": pa.array([0] * (n + asks), pa.int64()), "width": pa.array([2] * (n + asks), pa.int32()),
        "tree": pa.array([0] * (n + asks), pa.int32()),
        "string": pa.array([*strings.tolist(), *[int(low)] * asks]),
        "cid": pa.array([*range(n), *range(asks)], pa.int64()),
        "high": pa.array([*[None] * n, *[int(high)] * asks], pa.int64())})
    out = list(forest._gathered([batch], 20))
    assert max(b.num_rows for b in out) < 10 + 3
    found = {}
    for slab, q, block in zip(*(c for c in pa.Table.from_batches(out).to_pydict().values())):
        found.setdefault(q, []).extend(
            slab * 20 + np.cumsum(unsqueeze(block, np.uint16), dtype=np.int64))
    assert {q: sorted(v) for q, v in found.items()} == {q: list(range(n)) for q in range(asks)}


def test_slabs_and_few_queries_at_a_time(spark, monkeypatch):
    """Small slabs, several widths, equal vectors and a missing id: as by brute force."""
    monkeypatch.setattr(forest, "CHUNK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4 if i % 3 else 6).tolist()) for i in range(120)]
    rows += [(200 + i, rows[50][1]) for i in range(9)] + [(None, rows[100][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in forest.nearest_vectors(df, every=10, recall=1.0).collect()]
    want = brute.nearest(rows, every=10)
    assert {r[:2] for r in got} == {tuple(r)[:2] for r in want}
    same = {tuple(r)[:3] for r in got} & {tuple(r)[:3] for r in want}
    assert len(same) > 0.9 * len(want)
    # a task's own slab, with the queries of one comparison cut to two
    vectors = np.random.default_rng(4).normal(size=(14, 3))
    for at_once in (2, 128):
        monkeypatch.setattr(forest, "QUERIES", at_once)
        blocks = []
        for slab in (0, 1):
            for place in range(7):
                cid = 7 * slab + place
                blocks.append((slab, cid, None if cid == 3 else cid, 3, vectors[cid].tobytes(),
                               None, None))
            for q in (2, 9, 11):
                blocks.append((slab, None, None, None, vectors[q].tobytes(), q, None))
                blocks += [(slab, None, None, None, None, q, forest.squeeze(
                    np.array(p, np.uint16))) for p in ([0, 2, 1], [1, 5])]
        names = ["slab", "cid", "least", "width", "vector", "q", "found"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
        columns = [pa.array(c, kind) for c, kind in zip(zip(*blocks), kinds)]
        table = pa.Table.from_arrays(columns, names=names)
        out = pa.Table.from_batches(forest._compared(table.to_batches(max_chunksize=5), 2, 7))
        assert out.num_rows == 2 * 3 * 2
        for r in out.to_pylist():
            places = [7 * (r["cid"] // 7) + p for p in (0, 1, 2, 3, 6)]
            unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
            best = sorted(places, key=lambda c: -(unit[c] @ unit[r["q"]]))[:2]
            assert r["cid"] in best
            assert r["least"] == (None if r["cid"] == 3 else r["cid"])
            assert abs(r["score"] - unit[r["cid"]] @ unit[r["q"]]) < 1e-12
