"""Near-duplicate documents by Jaccard similarity of word n-grams, exactly.

Multiple-global-order filtering.  Sort a set's n-grams by any order that all
documents share: two sets of similarity >= t must have a common n-gram among
the first ``s - ceil(t*s) + 1`` of each.  That holds for every order at once,
so a pair is a candidate only if its prefixes meet under all of them.

* Order 1 puts rare n-grams first.  Rarity is the number of documents in a
  fixed number of hash buckets, counted over all documents, in 256 levels: a table of
  2**22 bytes whatever the input.  It only shapes the order; any table would
  give the same links.  Its prefixes are joined in Spark to find candidates.
* Orders 2 and 3 are two hash orders.  A candidate's prefixes under both must
  meet too, else it goes before verification.
* Before that, sketches of half a byte per n-gram give an upper bound of the
  common n-grams; a pair whose bound is too low goes without its sets being
  fetched.
* What is left is verified on the two whole sets.

Documents with the same set are one class from the start, so copies never meet
as pairs.  A posting list is not expanded into pairs either: its least class is
paired with the others and links are joined into components.  Only members
that are still in different components are paired again.  Long lists that one
pivot did not settle are not written out as pairs
at all: classes that share such lists form a cluster, and a cluster is compared
in blocks of ``BLOCK`` x ``BLOCK`` sets by matrix products, which return a
spanning forest of the links.  The components are the same as with all pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._spark import (
    bitmap, collected, connected_components, groups, in_bitmap, in_tasks, longs, saved, spanning,
)
from lodestar.llm._text import Words, mix, row_blocks, shingles
from lodestar.operators.joins import bounded_broadcast

BUCKET_BITS = 22       # the rarity table has 2**22 entries whatever the input
BUCKETS = 1 << BUCKET_BITS
_LOW_BITS = np.uint64(64 - BUCKET_BITS)
_PARTS = 64            # the table travels in so many pieces
FILTER_SEEDS = (101, 202)
PAIRS_AT_ONCE = 4      # lists of up to so many classes are paired completely at once
LONG_LIST = 32         # longer ones are compared in blocks
BLOCK = 512
_COLUMNS = 4096        # n-grams that a block's matrices hold at a time
NUM, DEN = 75, 100     # similarity 0.75
SHINGLE = 5
# Rows (three numbers each) that go to the tasks, so that the texts are not shuffled.
SENT_ROWS = 1 << 18


def prefix_length(size, num: int = NUM, den: int = DEN):
    """``s - ceil(t*s) + 1`` for sets of ``size`` (numbers or arrays)."""
    return size - (num * size + den - 1) // den + 1


def _fingerprints(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each row's set (0 for an empty one)."""
    out = []
    bounds = np.searchsorted(row, np.arange(n + 1))
    for seed in (11, 23):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h, seed), out=total[1:])
        size = np.diff(bounds).astype(np.uint64)
        out.append(np.where(size > 0, mix((total[bounds[1:]] - total[bounds[:-1]]) ^ size, seed), 0)
                   .astype(np.uint64))
    return out[0], out[1]


def _sets(column: pa.Array, size: int) -> Iterator[tuple]:
    """Per block: first row, rows, row and hash of each n-gram, fingerprints."""
    for first, last in row_blocks(column):
        n = last - first
        row, h = shingles(Words(column.slice(first, n), lower=True), size)
        yield first, n, row, h, *_fingerprints(row, h, n)


def _describe(batches, size: int, marks: list[str]):
    """Set size and class of every row, with its columns ``marks``; at the end this
    partition's rarity counts."""
    names = ["doc_id", "n_shingles", "cls", "check", "tally", *marks]
    tally = np.zeros(BUCKETS, np.uint8)
    for batch in batches:
        column = batch.column(1)
        for first, n, row, h, k1, k2 in _sets(column, size):
            bucket, times = np.unique((h >> _LOW_BITS).astype(np.int32), return_counts=True)
            tally[bucket] = np.minimum(tally[bucket] + times, 255)   # saturates per partition
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(np.bincount(row, minlength=n)),
                 longs(k1), longs(k2), pa.nulls(n, pa.binary()),
                 *[batch.column(c).slice(first, n) for c in marks]], names=names)
    packed = [zlib.compress(x.tobytes(), 1) for x in np.split(tally, _PARTS)]
    none = pa.nulls(_PARTS, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, pa.array(range(_PARTS), pa.int64()), none, none, pa.array(packed, pa.binary()),
         *[none for _ in marks]], names=names)


def rarity_levels(counts: np.ndarray) -> np.ndarray:
    """``counts`` as 256 levels: exact below 128, then some six to each doubling."""
    above = 128 + 6 * np.log2(np.maximum(counts, 128) / 128)
    return np.where(counts < 128, counts, np.minimum(above, 255)).astype(np.uint8)


def _add_up(batches):
    """Levels of the sums of the partitions' counts, one row for each part of the table."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = np.frombuffer(zlib.decompress(packed.as_buffer()), np.uint8)
            if part not in total:
                total[part] = np.zeros(len(counts), np.int64)
            total[part] += counts
    for part, counts in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([rarity_levels(counts).tobytes()])],
            names=["part", "levels"])


def rarity(tallies: DataFrame) -> np.ndarray:
    """Level of every bucket, rarest first, from the partitions' ``(part, tally)`` rows.

    The driver holds the table's 4 MB and no count."""
    levels = np.zeros((_PARTS, BUCKETS // _PARTS), np.uint8)
    for r in collected(tallies.repartition(_PARTS, "part")
                       .transform(in_tasks, _add_up, "part long, levels binary")):
        levels[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.ravel()


def _prefixes(batches, size: int, levels, num: int, den: int):
    """``(token, cls)`` for the prefix of every set under order 1: the level of rarity
    of the n-gram's bucket (the top 22 bits of its hash), then the hash.

    The token is the hash.  A class already sent by this partition is not sent again.
    """
    seen: set[int] = set()
    level = levels.value
    for batch in batches:
        for _, n, row, h, k1, _ in _sets(batch.column(0), size):
            fresh = np.zeros(n, bool)
            for i, k in enumerate(k1.tolist()):
                if k and k not in seen:
                    seen.add(k)
                    fresh[i] = True
            keep = fresh[row]
            row, h = row[keep], h[keep]
            # stable, and hashes ascend in each row
            at = np.lexsort((level[(h >> _LOW_BITS).astype(np.int64)], row))
            row, token = row[at], h[at]
            sizes = np.bincount(row, minlength=n)
            begin = np.cumsum(sizes) - sizes
            inside = np.arange(len(row)) - begin[row] < prefix_length(sizes, num, den)[row]
            yield pa.RecordBatch.from_arrays(
                [longs(token[inside]), longs(k1[row[inside]])], names=["token", "cls"])


def _of_classes(batches, size: int, wanted, name: str, value):
    """``(cls, value of its sorted set)`` of each wanted class, once per partition."""
    seen: set[int] = set()
    packed = wanted.value
    for batch in batches:
        for _, n, row, h, k1, _ in _sets(batch.column(0), size):
            hit = in_bitmap(packed, k1)
            bounds = np.searchsorted(row, np.arange(n + 1))
            keys, out = [], []
            for i in np.flatnonzero(hit).tolist():
                if (k := int(k1[i])) and k not in seen:
                    seen.add(k)
                    keys.append(i)
                    out.append(value(h[bounds[i]:bounds[i + 1]]))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [longs(k1[keys]), pa.array(out, pa.binary())], names=["cls", name])


def sketch(grams: np.ndarray) -> bytes:
    """One bit for each n-gram in a power of two of at least four times as many."""
    bits = 1 << max(6, int(4 * len(grams) - 1).bit_length())
    out = np.zeros(bits, bool)
    out[(mix(grams, 7) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def most_common(x: np.ndarray, size_x: int, y: np.ndarray, size_y: int) -> int:
    """An upper bound of the common n-grams of two sets from their sketches.

    Common n-grams share their bit; of those that share a bit with another one
    of their own set, no more than either set has can be hidden.
    """
    width = min(len(x), len(y))
    x, y = (np.bitwise_or.reduce(v.reshape(-1, width), axis=0) for v in (x, y))
    both = int(np.bitwise_count(x & y).sum())
    hidden = min(size_x - int(np.bitwise_count(x).sum()), size_y - int(np.bitwise_count(y).sum()))
    return both + hidden


def _may_link(batches, num: int, den: int):
    for batch in batches:
        keep = []
        for x, y, a, b in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(),
                              batch.column(5).to_pylist()):
            most = most_common(np.frombuffer(x.as_buffer(), np.uint8), a,
                               np.frombuffer(y.as_buffer(), np.uint8), b)
            keep.append(den * most >= num * (a + b - most))
        yield pa.RecordBatch.from_arrays(
            [pc.filter(batch.column(i), pa.array(keep, pa.bool_())) for i in (0, 1)],
            names=["a", "b"])


def meets(a: np.ndarray, b: np.ndarray, seed: int, num: int = NUM, den: int = DEN) -> bool:
    """Whether the prefixes of two sets under one hash order share an n-gram."""
    heads = []
    for x in (a, b):
        m, p = mix(x, seed), int(prefix_length(len(x), num, den))
        heads.append(np.partition(m, p - 1)[:p] if p < len(m) else m)
    return len(np.intersect1d(heads[0], heads[1])) > 0


def similar(a: np.ndarray, b: np.ndarray, num: int = NUM, den: int = DEN) -> bool:
    """``|a & b| / |a | b| >= num/den`` for two sorted sets without repeats."""
    if min(len(a), len(b)) * den < num * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * common >= num * (len(a) + len(b) - common)


def _verify(batches, num: int, den: int):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a = np.frombuffer(x.as_buffer(), np.uint64)
            b = np.frombuffer(y.as_buffer(), np.uint64)
            keep.append(min(len(a), len(b)) * den >= num * max(len(a), len(b))
                        and all(meets(a, b, s, num, den) for s in FILTER_SEEDS)
                        and similar(a, b, num, den))
        yield pa.RecordBatch.from_arrays(
            [pc.filter(batch.column(i), pa.array(keep, pa.bool_())) for i in (0, 1)],
            names=["a", "b"])


def _common(sets_a: list[np.ndarray], sets_b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from products of 0/1 matrices."""
    flat_a, flat_b = np.concatenate(sets_a), np.concatenate(sets_b)
    grams = np.intersect1d(flat_a, flat_b)
    out = np.zeros((len(sets_a), len(sets_b)), np.float32)
    sides = []
    for sets, flat in ((sets_a, flat_a), (sets_b, flat_b)):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(grams, flat), max(len(grams) - 1, 0))
        ok = grams[at] == flat if len(grams) else np.zeros(len(flat), bool)
        order = np.argsort(at[ok], kind="stable")
        sides.append((len(sets), row[ok][order], at[ok][order]))
    for first in range(0, len(grams), _COLUMNS):
        parts = []
        for n, row, at in sides:
            a, b = np.searchsorted(at, [first, first + _COLUMNS])
            m = np.zeros((n, min(_COLUMNS, len(grams) - first)), np.float32)
            m[row[a:b], at[a:b] - first] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def _heads(sets: list[np.ndarray], seed: int, num: int, den: int) -> list[np.ndarray]:
    out = []
    for x in sets:
        m, p = mix(x, seed), int(prefix_length(len(x), num, den))
        out.append(np.sort(np.partition(m, p - 1)[:p] if p < len(m) else m))
    return out


def _compare(batches, num: int, den: int):
    """Spanning links of every block of a cluster (rows sorted by block)."""
    for (_, low, high), parts in groups(batches, ["cluster", "low", "high"]):
        cls = np.concatenate([p.column("cls").to_numpy() for p in parts])
        label = np.concatenate([p.column("label").to_numpy() for p in parts])
        chunk = np.concatenate([p.column("chunk").to_numpy() for p in parts])
        sets = [np.frombuffer(g.as_buffer(), np.uint64) for p in parts for g in p.column("grams")]
        one, two = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
        if not len(one) or not len(two):
            continue
        size = np.array([len(x) for x in sets], np.int64)
        a, b = size[one][:, None], size[two]
        open_ = ((np.minimum(a, b) * den >= num * np.maximum(a, b))
                 & (label[one][:, None] != label[two]))
        left, right = [sets[i] for i in one], [sets[i] for i in two]
        for seed in FILTER_SEEDS:
            if open_.any():
                open_ &= _common(_heads(left, seed, num, den),
                                 _heads(right, seed, num, den)) > 0
        if not open_.any():
            continue
        common = _common(left, right).astype(np.int64)
        i, j = np.nonzero(open_ & (den * common >= num * (a + b - common)))
        i, j = cls[one[i]], cls[two[j]]
        used = spanning(i, j)
        if used:
            yield pa.RecordBatch.from_arrays([pa.array(i[used]), pa.array(j[used])],
                                             names=["a", "b"])


def _cluster_links(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between the classes of long lists (``s1, s2, cls, label``)."""
    pivots = members.groupBy("s1", "s2").agg(F.min("cls").alias("a"))
    clusters = connected_components(
        members.join(pivots, ["s1", "s2"]).select("a", F.col("cls").alias("b")))
    clusters = clusters.select("node", F.col("label").alias("cluster"))
    inside = saved(members.select("cls", "label").distinct()
                   .join(clusters, F.col("cls") == F.col("node"))
                   .select("cls", "label", "cluster"))
    chunks = inside.groupBy("cluster").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("chunks"))
    key = ["cluster", "low", "high"]
    met = (inside.join(chunks, "cluster")
           .withColumn("chunk", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
           .select("cls", "label", "cluster", "chunk", F.least("chunk", "other").alias("low"),
                   F.greatest("chunk", "other").alias("high")))
    return (met.join(sets, "cls").repartition(*key).sortWithinPartitions(*key)
            .transform(in_tasks, lambda it: _compare(it, num, den), "a long, b long"))


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    one = sets.select(F.col("cls").alias("a"), F.col("grams").alias("x"))
    two = sets.select(F.col("cls").alias("b"), F.col("grams").alias("y"))
    return (pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y")
            .transform(in_tasks, lambda it: _verify(it, num, den), "a long, b long"))


def _components(rows: DataFrame, size: int, num: int, den: int, least: Column,
                marks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """All of ``rows`` (``doc_id, text``) as ``(doc_id, n_shingles, cls, *marks)`` and,
    for every class with a word, ``(cls, least)``: the minimum of ``least`` over
    its component."""
    spark = rows.sparkSession
    extra = list(marks)
    described = saved(rows.select("*", *[c.alias(n) for n, c in marks.items()]).transform(
        in_tasks, lambda it: _describe(it, size, extra),
        "doc_id long, n_shingles long, cls long, check long, tally binary"
        + "".join(f", {n} long" for n in marks)))
    meta = described.where("tally IS NULL").drop("tally")
    members = meta.where("n_shingles > 0")
    clash = (members.groupBy("cls").agg(F.min("check").alias("lo"), F.max("check").alias("hi"))
             .where("lo <> hi").limit(1).count())
    if clash:
        raise RuntimeError("two different sets have one 64-bit fingerprint; change its seeds")

    sent = spark.sparkContext.broadcast(rarity(described.where("tally IS NOT NULL").select(
        F.col("n_shingles").alias("part"), "tally")))

    texts = rows.select("text")
    by_token = Window.partitionBy("token")
    ordered = by_token.orderBy("cls")
    shared = (texts.transform(in_tasks, lambda it: _prefixes(it, size, sent, num, den),
                               "token long, cls long")
              .withColumn("before", F.lag("cls").over(ordered))
              .where("before IS NULL OR before <> cls")
              .withColumn("n", F.count(F.lit(1)).over(by_token)).where("n > 1"))
    # n-grams held by the same classes are one list: it is known by two
    # fingerprints of its members
    lists = saved(shared
                  .withColumn("s1", F.bit_xor(F.xxhash64("cls", F.lit(1))).over(by_token))
                  .withColumn("s2", F.bit_xor(F.xxhash64("cls", F.lit(2))).over(by_token))
                  .select("s1", "s2", "n", "cls").distinct()
                  .withColumn("at", F.row_number().over(
                      Window.partitionBy("s1", "s2").orderBy("cls")))
                  .join(members.groupBy("cls").agg(F.first("n_shingles").alias("size")), "cls"))

    def of_classes(needed: DataFrame, name: str, value) -> DataFrame:
        """A value of the whole set of each needed class, from one more pass."""
        wanted = spark.sparkContext.broadcast(bitmap(needed, "cls"))
        return saved(texts.transform(
            in_tasks, lambda it: _of_classes(it, size, wanted, name, value),
            f"cls long, {name} binary").join(needed, "cls", "left_semi")
            .groupBy("cls").agg(F.first(name).alias(name)))

    sketches = of_classes(lists.select("cls").distinct(), "sketch", sketch)

    def likely(pairs: DataFrame) -> DataFrame:
        one = sketches.select(F.col("cls").alias("a"), F.col("sketch").alias("x"))
        two = sketches.select(F.col("cls").alias("b"), F.col("sketch").alias("y"))
        return saved(pairs.join(two, "b").join(one, "a").select("a", "b", "x", "y", "sa", "sb")
                     .transform(in_tasks, lambda it: _may_link(it, num, den), "a long, b long"))

    def sets_of(*pairs: DataFrame) -> DataFrame:
        needed = reduce(DataFrame.union, [p.select(F.col(c).alias("cls"))
                                          for p in pairs for c in p.columns])
        return of_classes(saved(needed.distinct()), "grams", lambda h: h.tobytes())

    def labelled(labels: DataFrame) -> DataFrame:
        return (lists.join(labels, lists["cls"] == labels["node"], "left")
                .withColumn("label", F.coalesce("label", "cls")).drop("node"))

    def unsettled(members: DataFrame) -> DataFrame:
        """Lists whose members are not all in one component yet."""
        mixed = (members.groupBy("s1", "s2")
                 .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .where("lo <> hi").select("s1", "s2"))
        return members.join(mixed, ["s1", "s2"], "left_semi")

    def paired(members: DataFrame, pivots: DataFrame) -> DataFrame:
        p = pivots.select("s1", "s2", F.col("cls").alias("a"), F.col("at").alias("pa"),
                          F.col("label").alias("la"), F.col("size").alias("sa"))
        # sets whose sizes differ too much cannot be similar; lists are in order
        # of their classes, so the pivot is always the lesser one
        return (members.join(p, ["s1", "s2"]).where("at > pa AND label <> la")
                .where(F.least("size", "sa") * den >= F.greatest("size", "sa") * num)
                .select("a", F.col("cls").alias("b"), "sa", F.col("size").alias("sb"))
                .distinct())

    first = lists.withColumn("label", F.col("cls"))
    pairs = likely(paired(first, first.where(f"at = 1 OR n <= {PAIRS_AT_ONCE}")))
    links = saved(_links(pairs, sets_of(pairs), num, den))
    labels = saved(connected_components(links))
    left = saved(unsettled(labelled(labels).where(f"n > {PAIRS_AT_ONCE}")))
    short, long = left.where(f"n <= {LONG_LIST}"), left.where(f"n > {LONG_LIST}")
    pairs = likely(paired(short, short.where("at > 1")))
    sets = sets_of(pairs, long.select("cls"))
    found = saved(_links(pairs, sets, num, den)
                  .union(_cluster_links(long.select("s1", "s2", "cls", "label"), sets, num, den)))
    if not found.isEmpty():
        labels = saved(connected_components(links.union(found)))

    classes = members.groupBy("cls").agg(F.min(least).alias("least"))
    named = classes.join(labels, classes["cls"] == labels["node"], "left").select(
        "cls", F.coalesce("label", "cls").alias("label"), "least")
    component = named.groupBy("label").agg(F.min("least").alias("first"))
    return meta, named.join(component, "label").select("cls", F.col("first").alias("least"))


def _rows(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Words are runs of anything but white space, A-Z in lower case.  A text with
    fewer than ``size`` words is one n-gram; a null text or one without words
    has an empty set, links with nothing and is its own component.  Documents
    link at similarity >= ``num/den``, tested in integers.  ``component_id`` is
    the least id reachable by links; rows without an id count as members but
    never name a component (it is null if no member has an id).  Repeated rows
    give repeated rows.  An empty table gives an empty result; other columns of
    ``docs`` play no part.
    """
    meta, of_class = _components(_rows(docs, text_col, id_col), size, num, den,
                                 F.col("doc_id"), {})
    return (meta.where("n_shingles > 0").join(of_class, "cls", "left")
            .select("doc_id", "n_shingles", F.col("least").alias("component_id"))
            .union(meta.where("n_shingles = 0")
                   .select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def keep_one_of_each(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     size: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one row of every component: one with the least id, of rows that
    share it the one whose text hashes least.

    A row without an id stays only if its component has no id at all.  Rows are
    told apart by id and text, so others of the same id are not touched; of
    equal rows any one stays.  Rows whose text has no words all stay.
    """
    # 128 bits of the text beside the id: a key that two rows share would drop both
    marks = {"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), F.col("text"))}
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"),
                     F.coalesce("doc_id", F.lit(0)).alias("id"), "t1", "t2")
    meta, of_class = _components(_rows(docs, text_col, id_col), size, num, den, order, marks)
    ruled = meta.where("n_shingles > 0").join(of_class, "cls")
    key = ["doc_id", *marks]
    stands = order == F.col("least")
    gone = ruled.where(~stands).select(*key).distinct()
    repeated = saved(ruled.where(stands).groupBy(*key).count().where("count > 1").select(*key))

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    mine = {"__id": F.col(f"`{id_col}`").cast("long"), "__t1": F.xxhash64(text),
            "__t2": F.xxhash64(F.lit(1), text)}

    def matched(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return df.join(keys, F.col("__id").eqNullSafe(F.col("doc_id__"))
                       & (F.col("__t1") == F.col("t1__")) & (F.col("__t2") == F.col("t2__")), how)

    gone, repeated = (bounded_broadcast(k, SENT_ROWS).toDF("doc_id__", "t1__", "t2__")
                      for k in (saved(gone), repeated))
    left = matched(docs.select("*", *[c.alias(n) for n, c in mine.items()]), gone, "left_anti")
    if not repeated.isEmpty():
        once = matched(left, repeated, "left_semi").dropDuplicates(list(mine))
        left = matched(left, repeated, "left_anti").union(once)
    return left.select(*[f"`{c}`" for c in docs.columns])
