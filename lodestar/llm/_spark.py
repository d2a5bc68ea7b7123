"""Spark helpers shared by the operators: checkpoints, bounded bitmaps, components."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir, ship_package, shuffles_freed

# Upper bound of a broadcast bitmap: 2**27 bits are 16 MB whatever the input.
MAX_BITMAP_BITS = 1 << 27
_BITS_PER_BLOCK = 1 << 16
# Rows in an Arrow batch: texts of a few thousand characters make some megabytes.
ROWS_AT_ONCE = 2000
# Links that a task contracts at once: 4 MB, some 30 MB while at work.
LINKS_AT_ONCE = 1 << 18


def in_tasks(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with this library at hand in the tasks.

    Batches are kept to ``ROWS_AT_ONCE`` rows, since a row can be a long text,
    and a worker, which lives on for other tasks, returns its memory at the end.
    """
    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))

    def run(batches):
        yield from function(batches)
        _release()

    return df.mapInArrow(run, schema)


def _release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):
        return      # another C library


def joined(batches, rows: int = 20_000):
    """The same rows in larger batches, for functions whose rows are small."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in ``spark.checkpoint.dir`` and cut from its lineage;
    what was shuffled for it is deleted."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def collected(df: DataFrame) -> list:
    """``df.collect()``; what was shuffled for it is deleted."""
    with shuffles_freed(df.sparkSession):
        return df.select("*").collect()


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as the text ''."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % F.lit(by)


def bitmap(keys: DataFrame, column: str, per_key: int = 16,
           max_bits: int = MAX_BITMAP_BITS) -> np.ndarray:
    """A bitmap (numpy uint8, packed) of the 64-bit values in ``column``.

    Bits are chosen by the value's low bits.  It has about ``per_key`` bits for
    each row and at most ``max_bits``, so what is sent is bounded by 16 MB; as
    it fills up, more rows pass :func:`in_bitmap`, none is lost.  Callers use
    it only to spare a shuffle of rows that an exact step would drop anyway.
    """
    rows = keys.count()
    bits = _BITS_PER_BLOCK
    while bits < min(rows * per_key, max_bits):
        bits *= 2
    # 64 bits at a time are united by the aggregate, combined before the shuffle;
    # tasks then join them to blocks of 8 KB, at most 2,048 of which are collected
    bit = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (keys.select(F.shiftright(bit, 6).alias("word"),
                         F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("held"))
             .groupBy("word").agg(F.bit_or("held").alias("held")))
    blocks = (words.groupBy(F.shiftright("word", 10).alias("block"))
              .agg(F.collect_list(F.struct(
                  F.col("word").bitwiseAND(F.lit(1023)).cast("int").alias("at"), "held")).alias("words"))
              .transform(in_tasks, _block_bytes, "block long, packed binary"))
    out = np.zeros(bits // 8, np.uint8)
    size = _BITS_PER_BLOCK // 8
    for row in collected(blocks):
        out[row["block"] * size:(row["block"] + 1) * size] = np.frombuffer(row["packed"], np.uint8)
    return out


def _block_bytes(batches):
    """``(block, words)`` rows as the bytes of each block."""
    for batch in batches:
        ends = batch.column(1).offsets.to_numpy()
        words = batch.column(1).values
        at, held = words.field("at").to_numpy(), words.field("held").to_numpy()
        packed = []
        for a, b in zip(ends[:-1], ends[1:]):
            block = np.zeros(_BITS_PER_BLOCK // 64, "<i8")
            block[at[a:b]] = held[a:b]
            packed.append(block.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())],
                                         names=["block", "packed"])


def in_bitmap(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which 64-bit ``values`` may be in the bitmap."""
    bit = (values & np.uint64(len(packed) * 8 - 1)).astype(np.int64)
    return (packed[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def groups(batches, keys: list[str]):
    """``(key, batches)`` of every group in a partition that is sorted by ``keys``
    (whole numbers).  Holds one group at a time."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        table = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys], 1)
        cuts = (np.flatnonzero((table[1:] != table[:-1]).any(axis=1)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(table)]):
            if a == b:
                continue
            key = tuple(table[a].tolist())
            if key != held_key:
                if held:
                    yield held_key, held
                held, held_key = [], key
            held.append(batch.slice(a, b - a))
    if held:
        yield held_key, held


def spanning(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Which of the links ``(a, b)`` a spanning forest needs."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    used = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            used.append(i)
    return used


def longs(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Arrow's signed integers (the same bits)."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def least_of_components(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links ``(u, v)`` and the least node of each one's component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[label]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))    # roots under lesser ones
        while len(np.flatnonzero((up := label[label]) != label)):
            label = up


def _contracted(batches, at_once: int):
    """Stars with the same components as each ``at_once`` links or so."""
    for batch in joined(batches, at_once):
        node, least = least_of_components(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        other = node != least
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(least[other])],
                                         names=["u", "v"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         at_once: int = LINKS_AT_ONCE) -> DataFrame:
    """``(node, label)`` for every node of an edge list, ``label`` its component's least node.

    Tasks contract ``at_once`` links each to stars; where there are too many links
    for one task, alternating large-star and small-star steps follow, each a least-neighbour
    aggregate (combined before the shuffle) and a join that AQE can split, so
    a node with a third of all edges is neither collected nor held by a task.
    Ends when a round changes nothing or one task has contracted what is left.
    Every exchange of a round costs the driver threads and generated code, whatever the
    number of links.  Nulls and self-loops are ignored.
    """
    cur = saved(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
                .where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        mark = cur.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        tasks = -(-mark[0] // at_once)
        stars = cur.coalesce(max(1, tasks)).transform(
            in_tasks, lambda it: _contracted(it, at_once), "u long, v long")
        if tasks <= 1:
            cur = saved(stars)
            break
        cur = saved(stars.distinct())
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        cur = saved(small.union(down.select("u", F.col("m").alias("v"))).distinct())
    # every edge now points from a node to its component's least node
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct())
