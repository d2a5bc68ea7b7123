"""Near-duplicate vectors by cross-polytope hashing.

A table rotates every vector by three rounds of random signs and a fast
Hadamard transform and takes the nearest signed axis, ``per_hash`` times with
different signs; the axes together are the bucket.  A vector lives in its own
bucket and also visits the ``probes`` next likely ones, where the runner-up
axes stand in.  Vectors that meet are compared exactly, in double precision.

Equal vectors are one class before anything else.  Pairs are not written out:
a bucket's rows are compared as blocks of at most ``BLOCK`` x ``BLOCK`` (a
bucket of any size is cut into blocks, so none is too large for a task), and a
block returns each member's number of links and a spanning forest of them.  A
pair that meets several times is counted where it meets first, which both
members' hash codes tell without any exchange.

The number of tables follows from the threshold alone: it is the least that
finds ``RECALL`` of simulated pairs at exactly that cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import connected_components, groups, in_tasks, saved, spanning

COSINE = 0.9
RECALL = 0.99
BLOCK = 512
ROUNDS = 3
MAX_TABLES = 64
SIMULATED = 2000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row (a power of two wide)."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        x = x.reshape(n, d)
        step *= 2
    return x / math.sqrt(d)


class CrossPolytope:
    """Hash codes of vectors of one width."""

    def __init__(self, width: int, per_hash: int, tables: int, probes: int, seed: int = 5):
        self.width, self.per_hash, self.tables, self.probes = width, per_hash, tables, probes
        self.padded = 1 << max(1, (width - 1).bit_length())
        rng = np.random.default_rng([seed, width])
        self.signs = rng.choice([-1.0, 1.0], (tables, per_hash, ROUNDS, self.padded))

    def codes(self, x: np.ndarray) -> np.ndarray:
        """``(rows, tables, 1 + probes)`` buckets: a row's own, then those it visits."""
        n = len(x)
        wide = np.zeros((n, self.padded))
        wide[:, :self.width] = x
        out = np.empty((n, self.tables, 1 + self.probes), np.int64)
        for t in range(self.tables):
            best, second, gap = [], [], []
            for k in range(self.per_hash):
                y = wide
                for r in range(ROUNDS):
                    y = hadamard(y * self.signs[t, k, r])
                size = np.abs(y)
                order = np.argpartition(-size, 1, axis=1)[:, :2]
                two = np.take_along_axis(size, order, 1)
                flip = two[:, 0] < two[:, 1]
                order[flip] = order[flip][:, ::-1]
                axis = 2 * order + (np.take_along_axis(y, order, 1) < 0)
                best.append(axis[:, 0])
                second.append(axis[:, 1])
                gap.append(np.abs(two[:, 0] - two[:, 1]))
            # every choice of best or runner-up axis, cheapest changes first
            choices = np.arange(1, 1 << self.per_hash)
            cost = np.stack([sum(gap[k] for k in range(self.per_hash) if c >> k & 1)
                             for c in choices], 1)
            order = np.argsort(cost, axis=1, kind="stable")[:, :self.probes]
            out[:, t, 0] = self._bucket(best)
            for j in range(self.probes):
                pick = choices[order[:, j]]
                out[:, t, 1 + j] = self._bucket(
                    [np.where(pick >> k & 1, second[k], best[k]) for k in range(self.per_hash)])
        return out

    def _bucket(self, axes: list[np.ndarray]) -> np.ndarray:
        code = np.zeros(len(axes[0]), np.int64)
        for a in axes:
            code = code * (2 * self.padded) + a
        return code


def meets(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of codes ``(pairs, tables, 1 + probes)``: the bucket of the first
    table in which they meet, ``(pairs, 2)`` as (table, bucket), -1 for none."""
    own_a, own_b = a[:, :, :1], b[:, :, :1]
    in_b = (a == own_b).any(axis=2)            # a lives in or visits b's bucket
    in_a = (b == own_a).any(axis=2)
    far = np.iinfo(np.int64).max
    bucket = np.minimum(np.where(in_b, own_b[:, :, 0], far), np.where(in_a, own_a[:, :, 0], far))
    met = in_a | in_b
    first = met.argmax(axis=1)
    rows = np.arange(len(a))
    out = np.stack((first, bucket[rows, first]), 1)
    out[~met.any(axis=1)] = -1
    return out


def choose(width: int, rows: int, cosine: float, recall: float = RECALL) -> CrossPolytope:
    """Hashes for ``rows`` vectors: as many axes per hash as leave a few vectors a
    bucket, and as many tables as find ``recall`` of simulated pairs at ``cosine``."""
    axes = 2 << max(1, (width - 1).bit_length())
    per_hash = max(1, min(8, round(math.log(max(rows / 4, 2)) / math.log(axes))))
    probes = min((1 << per_hash) - 1, 3 * per_hash)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(SIMULATED, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-300)
    y = cosine * x + math.sqrt(1 - cosine * cosine) * z
    tables, found = 4, None
    while True:
        h = CrossPolytope(width, per_hash, tables, probes)
        found = (meets(h.codes(x), h.codes(y))[:, 0] >= 0).mean()
        if found >= recall or tables >= MAX_TABLES:
            return h
        tables += 2


def _pack(batches, hashes):
    """Vectors as doubles with all their hash codes."""
    for batch in batches:
        vectors = batch.column(1)
        n = len(vectors)
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        x = flat.reshape(n, -1)
        codes = hashes.value.codes(x / np.linalg.norm(x, axis=1, keepdims=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([r.tobytes() for r in x], pa.binary()),
             pa.array([r.tobytes() for r in codes], pa.binary()),
             pa.array(codes.reshape(n, -1).tolist(), pa.list_(pa.int64()))],
            names=["cid", "n", "vector", "codes", "places"])


def _compare(batches, shape: tuple, cosine: float):
    """Link counts and spanning links of every block (rows sorted by block)."""
    for (t, bucket, low, high), parts in groups(batches, ["t", "bucket", "low", "high"]):
        cid = np.concatenate([p.column("cid").to_numpy() for p in parts])
        own = np.concatenate([p.column("own").to_numpy(zero_copy_only=False) for p in parts])
        if len(cid) < 2 or not own.any():
            continue
        side = np.concatenate([p.column("chunk").to_numpy() for p in parts])
        weight = np.concatenate([p.column("n").to_numpy() for p in parts])
        x = np.stack([np.frombuffer(v.as_buffer()) for p in parts for v in p.column("vector")])
        norm = np.linalg.norm(x, axis=1)
        one, two = np.flatnonzero(side == low), np.flatnonzero(side == high)
        close = (x[one] @ x[two].T) / (norm[one][:, None] * norm[two]) >= cosine
        close &= own[one][:, None] | own[two]
        i, j = np.nonzero(close)
        i, j = one[i], two[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        codes = np.stack([np.frombuffer(v.as_buffer(), np.int64).reshape(shape)
                          for p in parts for v in p.column("codes")])
        keep = np.empty(len(i), bool)
        for a in range(0, len(i), 1 << 14):          # bounded memory
            first = meets(codes[i[a:a + (1 << 14)]], codes[j[a:a + (1 << 14)]])
            keep[a:a + (1 << 14)] = (first[:, 0] == t) & (first[:, 1] == bucket)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        links = np.bincount(i, weight[j], len(cid)) + np.bincount(j, weight[i], len(cid))
        some = np.flatnonzero(links)
        used = spanning(i, j)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((cid[some], cid[i[used]]))),
             pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(cid[j[used]])]),
             pa.array(np.concatenate((links[some], np.zeros(len(used)))).astype(np.int64))],
            names=["a", "b", "links"])


def near_duplicate_vectors(vectors: DataFrame, vector_col: str = "embedding",
                           id_col: str = "vec_id", cosine: float = COSINE,
                           recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    ``n_links`` counts the other rows at cosine >= ``cosine`` that were found
    (equal vectors always; others with at least ``recall`` at the threshold
    itself, more above it); no pair below it is ever linked.
    ``component_id`` is the least id reachable by links, ``kept`` whether that
    is the row's own.  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing; vectors of different widths do
    not link.  Rows without an id link like others but never name a component
    (null if no member has an id; such a row is kept then).  Repeated rows
    count as separate rows.  Other columns play no part.
    """
    x = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    good = (x.isNotNull() & (F.size(x) > 0)
            & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)
                                  & (F.abs(v) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False)))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    usable = rows.where("good").select(
        "vec_id", "vector", F.xxhash64("vector").alias("h"), F.size("vector").alias("width"))
    classes = saved(usable.groupBy("h", "vector").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"),
        F.first("width").alias("width")).withColumn("cid", F.monotonically_increasing_id()))

    found = None
    for r in classes.groupBy("width").count().collect():
        width, size = r["width"], r["count"]
        if size < 2:
            continue
        part = _links_of_width(classes.where(F.col("width") == width), width, size, cosine, recall)
        found = part if found is None else found.union(part)
    if found is None:
        found = classes.limit(0).select(F.col("cid").alias("a"), F.col("cid").alias("b"),
                                        F.col("n").alias("links"))
    found = saved(found)
    counted = found.groupBy("a").agg(F.sum("links").alias("linked"))
    labels = connected_components(found.where("b IS NOT NULL"))
    named = (classes.select("h", "vector", "cid", "least", "n")
             .join(labels, F.col("cid") == F.col("node"), "left")
             .withColumn("label", F.coalesce("label", "cid"))
             .join(counted, F.col("cid") == F.col("a"), "left"))
    component = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = named.join(component, "label").select(
        "h", F.col("vector").alias("v"), "component_id",
        (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = (usable.join(of_class, (usable["h"] == of_class["h"])
                       & (usable["vector"] == of_class["v"]), "left")
           .select("vec_id", "n_links", "component_id"))
    alone = rows.where(~F.col("good")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _links_of_width(classes: DataFrame, width: int, size: int, cosine: float,
                    recall: float) -> DataFrame:
    """``(a, b, links)``: link counts (b null) and spanning links of one width's classes."""
    hashes = choose(width, size, cosine, recall)
    sent = classes.sparkSession.sparkContext.broadcast(hashes)
    per_table = 1 + hashes.probes
    packed = saved(classes.select("cid", "vector", "n").transform(in_tasks, 
        lambda it: _pack(it, sent),
        "cid long, n long, vector binary, codes binary, places array<long>"))
    places = packed.select("cid", F.posexplode("places").alias("i", "bucket")).select(
        "cid", F.floor(F.col("i") / per_table).cast("int").alias("t"), "bucket",
        (F.col("i") % per_table == 0).alias("own"))
    # buckets where nobody lives, or nobody else comes, hold no pair
    sizes = (places.groupBy("t", "bucket")
             .agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("own").cast("int")).alias("owners"))
             .where("m > 1 AND owners > 0")
             .withColumn("chunks", F.ceil(F.col("m") / BLOCK).cast("int")))
    chunk = F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    met = (places.join(sizes, ["t", "bucket"]).withColumn("chunk", chunk)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .select("cid", "t", "bucket", "own", "chunk", F.least("chunk", "other").alias("low"),
                   F.greatest("chunk", "other").alias("high")))
    key = ["t", "bucket", "low", "high"]
    blocks = (met.join(packed.drop("places"), "cid").repartition(*key)
              .sortWithinPartitions(*key))
    shape = (hashes.tables, per_table)
    return blocks.transform(in_tasks, lambda it: _compare(it, shape, cosine),
                             "a long, b long, links long")
