"""Approximate nearest neighbours by a forest of hash-prefix trees.

Each tree gives a vector a long string of bits (the sides of random planes) and
is held as the sorted array of all strings, range-partitioned by Spark: the
vectors below a node are those that share its prefix, one stretch of the array.

A query *descends* in every tree to its own place.  It then *ascends* in all
trees at once, one bit after the other: prefixes of one length, and with them
the stretches around the query, widen together until all trees hold ``wanted``
entries.  Its candidates are all vectors of these stretches, however many; they
are compared exactly, in double precision.

``wanted`` follows from the data.  For a bounded sample of the queries one scan
of the vectors finds their true neighbours, at which prefix length each is
reached and how many entries every length holds; ``wanted`` is the least number
that reaches the recall asked for.

Equal vectors are one class, of which only the ``k + 1`` least ids can be
answers.  Vectors are never sent once per tree: candidates are lists of class
numbers, cut at the bounds of slabs of ``CHUNK`` classes.  At the end every vector
goes to its slab once, and every query to the slabs that hold candidates of it,
where its lists are united.  A task holds one sorted stretch or one slab, and
``QUERIES`` queries at a time, whatever the number of vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._blocks import squeeze, unsqueeze
from lodestar.llm._spark import collected, groups, in_tasks, joined, saved

NEAREST = 5
EVERY = 50
TREES = 16
BITS = 64
RECALL = 0.95
SAMPLE = 64
SEED = 13
# Entries of a sorted stretch, stretches at most (their bounds are sent to all
# tasks), queries compared at once, vectors of a slab at most (their places in it
# have 16 bits) and slabs at least.
STRETCH = 400_000
MAX_STRETCHES = 50_000
QUERIES = 128
CHUNK = 16_384
SLABS = 16
# Rows and bytes of candidate lists that a task holds before it sends them.
LISTS_AT_ONCE = 20_000
BYTES_AT_ONCE = 4 << 20

_TOP = np.uint64(1 << 63)


class Planes:
    """Random planes of every width, and the strings of vectors."""

    def __init__(self, trees: int, seed: int):
        self.trees, self.seed = trees, seed
        self._of: dict[int, np.ndarray] = {}

    def strings(self, x: np.ndarray) -> np.ndarray:
        """``(rows, trees)`` strings, as whole numbers whose order is that of the bits."""
        width = x.shape[1]
        if width not in self._of:
            self._of[width] = np.random.default_rng([self.seed, width]).normal(
                size=(width, self.trees * BITS))
        sides = np.packbits(x @ self._of[width] > 0, axis=1)
        return signed(np.ascontiguousarray(sides).view(">u8").astype(np.uint64))


def signed(strings: np.ndarray) -> np.ndarray:
    """Unsigned numbers as signed ones in the same order."""
    return (strings ^ _TOP).view(np.int64)


def unsigned(numbers: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(numbers).view(np.uint64) ^ _TOP


def stretch(strings: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest string with the same first ``level`` bits (unsigned)."""
    level = np.broadcast_to(np.asarray(level, np.uint64), strings.shape)
    free = np.where(level == 0, np.uint64(2**64 - 1),
                    np.left_shift(np.uint64(1), np.uint64(BITS) - np.maximum(level, np.uint64(1)))
                    - np.uint64(1))
    return strings & ~free, strings | free


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of first bits that two strings share."""
    differ = a ^ b
    high = (differ >> np.uint64(32)).astype(np.float64)
    low = (differ & np.uint64(2**32 - 1)).astype(np.float64)
    return BITS - np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def unit_scale(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component near 1; no bit of
    a component is lost and no square over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` and ``y`` (scaled), the same wherever it is taken."""
    dot = np.einsum("ij,ij->i", x, y)
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def _vectors(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.stack([np.frombuffer(v.as_buffer()) for v in column])


def _hashed(batches, planes: Planes):
    for batch in batches:
        lists = batch.column("vector")
        sizes = np.diff(lists.offsets.to_numpy())
        for width in np.unique(sizes).tolist():
            at = pa.array(np.flatnonzero(sizes == width))
            part = batch.take(at)
            x = part.column("vector").flatten().to_numpy(zero_copy_only=False)
            x = unit_scale(x.astype(np.float64).reshape(-1, width))
            strings = planes.strings(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("cid"), part.column("least"), part.column("asked"),
                 pa.array(np.full(len(x), width, np.int32)),
                 pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.ListArray.from_arrays(
                     pa.array(np.arange(0, strings.size + 1, planes.trees, dtype=np.int32)),
                     pa.array(strings.ravel()))],
                names=["cid", "least", "asked", "width", "vector", "strings"])


_PACKED = "cid long, least long, asked boolean, width int, vector binary, strings array<long>"


def _strings(batch) -> np.ndarray:
    return unsigned(batch.column("strings").flatten().to_numpy()).reshape(batch.num_rows, -1)


def _sampled(batches, sample: list, k: int):
    """For each query of the sample: entries by prefix length, and the nearest ``k``
    classes of a task with the length at which they are reached."""
    tally = np.zeros((len(sample), BITS + 1), np.int64)
    score = np.full((len(sample), k), -np.inf)
    level = np.zeros((len(sample), k), np.int64)
    seen = False
    for batch in joined(batches, 4096):
        seen = True
        widths = batch.column("width").to_numpy()
        for width in np.unique(widths).tolist():
            part = batch.take(pa.array(np.flatnonzero(widths == width)))
            x, cid, strings = _vectors(part.column("vector")), part.column("cid").to_numpy(), None
            norm = np.linalg.norm(x, axis=1)
            for i, (own, v, s) in enumerate(sample):
                if len(v) != width:
                    continue
                strings = _strings(part) if strings is None else strings
                shared = common_prefix(strings, s[None, :])
                tally[i] += np.bincount(shared.ravel(), minlength=BITS + 1)
                near = x @ v / (norm * np.linalg.norm(v))
                near[cid == own] = -np.inf
                both = np.concatenate((score[i], near))
                reach = np.concatenate((level[i], shared.max(axis=1)))
                top = np.argsort(-both, kind="stable")[:k]
                score[i], level[i] = both[top], reach[top]
    if seen:
        n = len(sample)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n, dtype=np.int32)), pa.array(tally.tolist(), pa.list_(pa.int64())),
             pa.array(score.tolist(), pa.list_(pa.float64())),
             pa.array(level.tolist(), pa.list_(pa.int64()))],
            names=["s", "tally", "score", "level"])


def entries_wanted(packed: DataFrame, k: int, recall: float, sample: int) -> int:
    """The least number of entries (of all trees together) at which the ascent of at
    most ``sample`` queries may stop to find ``recall`` of their true neighbours."""
    asked = [(r["cid"], np.frombuffer(r["vector"]), unsigned(np.array(r["strings"], np.int64)))
             for r in packed.where("asked").orderBy(F.xxhash64("vector"), "cid").limit(sample)
             .collect()]
    found = saved(in_tasks(packed, lambda it: _sampled(it, asked, k),
                           "s int, tally array<long>, score array<double>, level array<long>"))
    tally = np.zeros((len(asked), BITS + 1), np.int64)
    for r in (found.select("s", F.posexplode("tally").alias("x", "n")).groupBy("s", "x")
              .agg(F.sum("n").alias("n")).collect()):
        tally[r["s"], r["x"]] = r["n"]
    near = (found.select("s", F.explode(F.arrays_zip("score", "level")).alias("e"))
            .select("s", "e.*").where(F.col("score") > float("-inf"))
            .withColumn("r", F.row_number().over(
                Window.partitionBy("s").orderBy(F.desc("score"), F.desc("level"))))
            .where(F.col("r") <= k).collect())
    held = tally[:, ::-1].cumsum(axis=1)[:, ::-1]        # entries that share x bits or more
    most = int(held[:, 0].max(initial=1))
    if not near:
        return most
    who, reach = np.array([(r["s"], r["level"]) for r in near]).T
    step = 0
    while (wanted := int(2 ** (step / 2))) <= most:
        if (stops(held, wanted)[who] <= reach).mean() >= recall:
            return wanted
        step += 1
    return most + 1


def stops(held: np.ndarray, wanted: int) -> np.ndarray:
    """Greatest prefix length at which a row's entries are ``wanted`` or more; else 0."""
    enough = held >= wanted
    return np.where(enough.any(axis=1), BITS - enough[:, ::-1].argmax(axis=1), 0)


class Stretches:
    """Bounds of the sorted stretches of every tree: one for each tree and partition."""

    def __init__(self, rows: list):
        self.of: dict[tuple[int, int], tuple] = {}
        rows = sorted((r["width"], r["tree"], r["pid"], r["first"], r["last"], r["n"])
                      for r in rows)
        cuts = [i for i, r in enumerate(rows) if i == 0 or r[:2] != rows[i - 1][:2]]
        for a, b in zip(cuts, [*cuts[1:], len(rows)]):
            pid, first, last, n = (np.array([r[j] for r in rows[a:b]], np.int64)
                                   for j in range(2, 6))
            self.of[rows[a][:2]] = (pid, unsigned(first), unsigned(last),
                                    np.concatenate(([0], np.cumsum(n))))

    def whole(self, key: tuple[int, int], low, high, own: int) -> np.ndarray:
        """Entries of the stretches that lie between ``low`` and ``high``, without ``own``."""
        pid, first, last, total = self.of[key]
        a = np.searchsorted(first, low, "left")
        b = np.maximum(np.searchsorted(last, high, "right"), a)
        at = int(np.searchsorted(pid, own))
        inside = (a <= at) & (at < b)
        return total[b] - total[a] - np.where(inside, total[at + 1] - total[at], 0)

    def touched(self, key: tuple[int, int], low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Partitions, and the range of them that holds strings from ``low`` to ``high``."""
        pid, first, last, _ = self.of[key]
        return pid, np.searchsorted(last, low, "left"), np.searchsorted(first, high, "right")


def _descended(batches, bounds):
    """Each query's place: how many entries share x bits with it, for every x."""
    for (pid, width, tree), parts in groups(batches, ["pid", "width", "tree"]):
        asked = np.concatenate([p.column("asked").to_numpy(zero_copy_only=False) for p in parts])
        at = np.flatnonzero(asked)
        if not len(at):
            continue
        strings = unsigned(np.concatenate([p.column("string").to_numpy() for p in parts]))
        cid = np.concatenate([p.column("cid").to_numpy() for p in parts])[at]
        own = strings[at]
        held = np.empty((len(at), BITS + 1), np.int64)
        for x in range(BITS + 1):
            low, high = stretch(own, x)
            held[:, x] = (np.searchsorted(strings, high, "right")
                          - np.searchsorted(strings, low, "left")
                          + bounds.value.whole((width, tree), low, high, pid))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cid), pa.ListArray.from_arrays(
                pa.array(np.arange(len(at) + 1, dtype=np.int32) * (BITS + 1)),
                pa.array(held.ravel()))], names=["cid", "held"])


def _ascended(batches, wanted: int, bounds):
    """Where each query's candidates lie: a row for every stretch that holds some."""
    for batch in batches:
        held = batch.column("held").flatten().flatten().to_numpy()
        trees = batch.column("strings").value_lengths()[0].as_py() if batch.num_rows else 1
        held = held.reshape(batch.num_rows, trees, BITS + 1).sum(axis=1)
        level, strings = stops(held, wanted), _strings(batch)
        widths = batch.column("width").to_numpy()
        for width in np.unique(widths).tolist():
            for tree in range(trees):
                # without any common bit all rows are candidates, and one tree has them
                rows = np.flatnonzero((widths == width) & ((level > 0) | (tree == 0)))
                low, high = stretch(strings[rows, tree], level[rows])
                pid, a, b = bounds.value.touched((width, tree), low, high)
                times = b - a
                which = np.repeat(np.arange(len(rows)), times)
                end = np.cumsum(times)
                part = np.arange(len(which)) - np.repeat(end - times, times) + a[which]
                n = len(which)
                row = pa.array(rows[which])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pid[part]), pa.array(np.full(n, width, np.int32)),
                     pa.array(np.full(n, tree, np.int32)), pa.array(signed(low[which])),
                     batch.column("cid").take(row), pa.array(signed(high[which]))],
                    names=["pid", "width", "tree", "string", "cid", "high"])


def _gathered(batches, chunk: int):
    """Candidates of every query from one stretch (its entries come before the queries),
    a list for each slab of ``chunk`` classes: their places in it."""
    for _, parts in groups(batches, ["pid", "width", "tree"]):
        table = pa.Table.from_batches(parts)
        entry = table["high"].is_null().to_numpy()
        strings, cid = unsigned(table["string"].to_numpy()), table["cid"].to_numpy()
        asks = np.flatnonzero(~entry)
        if not len(asks):
            continue
        own, classes = strings[entry], cid[entry]
        a = np.searchsorted(own, strings[asks], "left")
        high = table["high"].take(pa.array(asks)).to_numpy()
        b = np.searchsorted(own, unsigned(high), "right")
        slabs, queries, found, size = [], [], [], 0
        for q, x, y in zip(cid[asks].tolist(), a.tolist(), b.tolist()):
            slab, place = np.divmod(np.sort(classes[x:y]), chunk)
            cuts = np.flatnonzero(np.diff(slab, prepend=-1))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(slab)]):
                slabs.append(int(slab[i]))
                queries.append(q)
                found.append(squeeze(np.diff(place[i:j], prepend=0).astype(np.uint16)))
                size += len(found[-1])
            if len(found) >= LISTS_AT_ONCE or size >= BYTES_AT_ONCE:
                yield _lists(slabs, queries, found)
                slabs, queries, found, size = [], [], [], 0
        yield _lists(slabs, queries, found)


def _lists(slabs: list[int], queries: list[int], found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(slabs, pa.int64()), pa.array(queries, pa.int64()),
         pa.array(found, pa.binary())], names=["slab", "q", "found"])


class _Slab:
    """The vectors of one slab, by their places in it."""

    def __init__(self, number: int, chunk: int):
        self.number, self.chunk = number, chunk
        self._rows: list[pa.RecordBatch] = []
        self.of: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, rows: pa.RecordBatch) -> None:
        self._rows.append(rows)

    def close(self) -> None:
        """No vector follows: a matrix for each width, and the row of each place in it."""
        if not self._rows:
            return
        table = pa.Table.from_batches(self._rows).combine_chunks()
        self._rows = []
        place = table["cid"].to_numpy() - self.number * self.chunk
        null = table["least"].is_null().to_numpy()
        self.null, self.least = (np.zeros(self.chunk, kind) for kind in (bool, np.int64))
        self.null[place], self.least[place] = null, table["least"].fill_null(0).to_numpy()
        widths = table["width"].to_numpy()
        for width in np.unique(widths).tolist():
            at = np.flatnonzero(widths == width)
            row = np.zeros(self.chunk, np.int32)
            row[place[at]] = np.arange(len(at))
            x = _vectors(table["vector"].take(pa.array(at)))
            self.of[width] = row, x, np.linalg.norm(x, axis=1)

    def compare(self, queries: list, k: int):
        """The ``k`` nearest classes of queries ``(q, vector, lists)``, exactly."""
        out = []
        for width in {len(v) for _, v, _ in queries}:
            some = [each for each in queries if len(each[1]) == width]
            row, x, size = self.of[width]
            asked = np.stack([v for _, v, _ in some])
            rough = (asked / np.linalg.norm(asked, axis=1)[:, None]) @ x.T
            rough /= size
            for i, (q, v, lists) in enumerate(some):
                hit = np.zeros(self.chunk, bool)
                for block in lists:
                    hit[np.cumsum(unsqueeze(block, np.uint16), dtype=np.int64)] = True
                place = np.flatnonzero(hit)
                near = rough[i, row[place]]
                if len(place) > k:
                    place = place[near >= np.partition(near, -k)[-k] - 1e-9]
                score = cosines(x[row[place]], np.broadcast_to(v, (len(place), width)))
                top = np.lexsort((self.least[place], self.null[place], -score))[:k]
                place = place[top]
                out.append((np.full(len(top), q), place + self.number * self.chunk, score[top],
                            self.least[place], self.null[place]))
        q, cid, score, least, null = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(q), pa.array(cid), pa.array(score), pa.array(least, mask=null)],
            names=["q", "cid", "score", "least"])


def _compared(batches, k: int, chunk: int):
    """The ``k`` nearest classes of every query within a slab.

    A slab's vectors come first (``q`` is null), then each query with its vector and
    after it its lists; ``QUERIES`` queries are held at a time.
    """
    slab, queries = None, []
    for batch in batches:
        numbers = batch.column("slab").to_numpy()
        entry = batch.column("q").is_null().to_numpy(zero_copy_only=False)
        kind = numbers * 2 + ~entry         # vectors or queries of a slab
        cuts = np.flatnonzero(np.diff(kind, prepend=-1)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(kind)]):
            if slab is None or slab.number != numbers[a]:
                if queries:
                    yield slab.compare(queries, k)
                slab, queries = _Slab(int(numbers[a]), chunk), []
            if entry[a]:
                slab.add(batch.slice(a, b - a))
                continue
            slab.close()
            part = batch.slice(a, b - a)
            for q, v, block in zip(part.column("q").to_pylist(), part.column("vector"),
                                   part.column("found").to_pylist()):
                if block is not None:
                    queries[-1][2].append(block)
                    continue
                if len(queries) == QUERIES:
                    yield slab.compare(queries, k)
                    queries = []
                queries.append((q, np.frombuffer(v.as_buffer()), []))
    if queries:
        yield slab.compare(queries, k)


def nearest_vectors(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
                    k: int = NEAREST, every: int = EVERY, recall: float = RECALL,
                    sample: int = SAMPLE, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every query, by cosine.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but the query's own.  ``score`` is the cosine in double precision;
    rank 1 is the nearest, ties go to the smaller id.  ``recall`` is aimed at on
    at most ``sample`` queries, by which alone the index is fitted.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part; vectors of different widths are not compared.  Rows without
    an id are candidates (last among ties), never queries.  Repeated rows count
    as separate rows: each is a query and a candidate of the others.  With
    fewer than ``k`` candidates all are returned; without queries, or on an
    empty table, there are no rows.  Other columns play no part.
    """
    x = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    good = (x.isNotNull() & (F.size(x) > 0)
            & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)
                                  & (F.abs(v) < float("inf"))), F.lit(False))
            & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False)))
    usable = rows.where(good).withColumn("h", F.xxhash64("vector"))
    asked = usable.where(F.col("vec_id") % every == 0)

    # classes of equal vectors with their k + 1 least ids, cut before the shuffle
    order = Window.partitionBy("h", "vector").orderBy(F.col("vec_id").asc_nulls_last())
    members = (usable.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
               .groupBy("h", "vector")
               .agg(F.sort_array(F.collect_list(F.struct("r", "vec_id"))).alias("members")))
    classes = _numbered(saved(
        members.join(asked.select("h", "vector", F.lit(True).alias("asked")).distinct(),
                     ["h", "vector"], "left")
        .select("h", "vector", "members", F.coalesce("asked", F.lit(False)).alias("asked"),
                F.monotonically_increasing_id().alias("cid"))))
    planes = Planes(trees, seed)
    packed = saved(in_tasks(classes.select(
        "cid", F.col("members")[0]["vec_id"].alias("least"), "asked", "vector"),
        lambda it: _hashed(it, planes), _PACKED))
    wanted = entries_wanted(packed, k, recall, sample)
    near = _search(packed, wanted, trees, k + 1)

    # classes to rows; the query's own row is taken out of its own class
    first = (near.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(
        F.desc("score"), F.col("least").asc_nulls_last()))).where(F.col("r") <= k + 1)
        .join(classes.select("cid", "members"), "cid")
        .select("q", "cid", "score", F.explode("members").alias("m"))
        .select("q", F.struct((-F.col("score")).alias("far"),
                              F.col("m.vec_id").isNull().alias("missing"),
                              F.col("m.vec_id").alias("vec_id"),
                              (F.col("cid") == F.col("q")).alias("own")).alias("row"))
        .groupBy("q").agg(F.sort_array(F.collect_list("row")).alias("rows")))
    queries = (asked.join(classes.select("h", "vector", F.col("cid").alias("q")), ["h", "vector"])
               .select(F.col("vec_id").alias("query_id"), "q").join(first, "q"))
    own = F.array_position(F.transform("rows", lambda r: r["own"] & F.equal_null(
        r["vec_id"], F.col("query_id"))), True)
    return (queries.withColumn("own", own)
            .withColumn("rows", F.slice(F.filter("rows", lambda r, i: i + 1 != F.col("own")), 1, k))
            .select("query_id", F.posexplode("rows").alias("rank", "row"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("row.vec_id").alias("vec_id"),
                    (-F.col("row.far")).alias("score")))


def _numbered(classes: DataFrame) -> DataFrame:
    """``classes`` with ``cid`` counted on from partition to partition, without gaps."""
    part = F.shiftright("cid", 33)
    sizes = sorted(tuple(r) for r in collected(
        classes.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))))
    before = np.cumsum([0, *(n for _, n in sizes)])[:-1]
    first = F.broadcast(classes.sparkSession.createDataFrame(pa.table({
        "part": pa.array([number for number, _ in sizes], pa.int64()),
        "before": pa.array(before, pa.int64())})))
    cid = F.col("before") + F.col("cid").bitwiseAND(F.lit((1 << 33) - 1))
    return (classes.join(first, part == first["part"])
            .select(*[cid.alias(c) if c == "cid" else c for c in classes.columns]))


def _search(packed: DataFrame, wanted: int, trees: int, k: int) -> DataFrame:
    """``(q, cid, score, least)``: the ``k`` nearest classes of each query, from every slab."""
    spark = packed.sparkSession
    n = packed.count()
    parts = max(1, min(MAX_STRETCHES, -(-n * trees // STRETCH)))
    chunk = max(1, min(CHUNK, -(-n // SLABS)))
    key = ["width", "tree", "string", "cid"]
    trees_sorted = saved(
        packed.select("width", F.posexplode("strings").alias("tree", "string"), "cid", "asked")
        .repartitionByRange(parts, *key).sortWithinPartitions(*key))
    entries = trees_sorted.withColumn("pid", F.spark_partition_id().cast("long"))
    bounds = spark.sparkContext.broadcast(Stretches(
        entries.groupBy("pid", "width", "tree").agg(
            F.min("string").alias("first"), F.max("string").alias("last"),
            F.count(F.lit(1)).alias("n")).collect()))
    places = (in_tasks(entries, lambda it: _descended(it, bounds), "cid long, held array<long>")
              .groupBy("cid").agg(F.collect_list("held").alias("held")))
    asks = in_tasks(places.join(packed.select("cid", "width", "strings"), "cid"),
                    lambda it: _ascended(it, wanted, bounds),
                    "pid long, width int, tree int, string long, cid long, high long")
    stretch_key = ["pid", "width", "tree"]
    met = (entries.drop("asked").unionByName(asks, allowMissingColumns=True)
           .repartition(*stretch_key)
           .sortWithinPartitions(*stretch_key, F.col("high").isNotNull(), "string"))
    found = saved(in_tasks(met, lambda it: _gathered(it, chunk),
                           "slab long, q long, found binary"))
    asked = found.select("slab", "q").distinct().join(
        packed.select(F.col("cid").alias("q"), "vector"), "q")
    slabs = (packed.select(F.floor(F.col("cid") / chunk).alias("slab"), "cid", "least", "width",
                           "vector")
             .unionByName(asked, allowMissingColumns=True)
             .unionByName(found, allowMissingColumns=True)
             .repartition("slab")
             .sortWithinPartitions("slab", F.col("q").asc_nulls_first(),
                                   F.col("found").isNotNull()))
    return in_tasks(slabs, lambda it: _compared(it, k, chunk),
                    "q long, cid long, score double, least long")
