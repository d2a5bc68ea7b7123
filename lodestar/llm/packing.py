"""Best-fit-decreasing packing of documents into fixed-length sequences.

Best fit decreasing only looks at lengths, and there are at most
``max_tokens`` of them.  So the packing is planned once, on the number of
pieces of each length (a table of at most ``max_tokens`` rows whatever the
input), and carried out by Spark on all pieces:

* documents of one length form a run; a run is placed by looking up, in a
  segment tree over remaining capacities, the tightest group of open bins that
  still takes it.  Bins that were filled alike stay one group, so placing ten
  or ten million documents of one length costs a few logarithmic searches.
  The bins are exactly those of document-by-document best fit decreasing;
* every piece gets its rank among the pieces of its length (windows over
  (length, salt), joined by counts, so that a length which a third of the rows
  share is not sorted by one task) and reads its bin and offset off the plan.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks, saved
from lodestar.llm._text import LOWER, Words, row_blocks

MAX_TOKENS = 2048
SALTS = 256
TOKENISED_BYTES = 1 << 22       # texts coded at once; they share the search for their units
END_ID = 0
_ZSTD = pa.Codec("zstd", 1)
_CODED = 0x80                   # packed ids: the rest is zstd's
# Kinds of bytes: a unit is a run of letters, one digit, or a run of others.
_LETTER, _DIGIT = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a"):ord("z") + 1] = _LETTER
_KIND[ord("0"):ord("9") + 1] = _DIGIT


class CapacityTree:
    """Segment tree over capacities 0..n: which have open bins, the least >= x."""

    def __init__(self, n: int):
        self.size = 1 << (n + 1).bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.size
        self.open[at] = is_open
        at >>= 1
        while at:
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]
            at >>= 1

    def tightest(self, least: int) -> int:
        """The least open capacity >= ``least``, or -1."""
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return -1


@dataclass
class Plan:
    """Placement of ranks: a piece of ``length[i]`` with rank r, for the last i with
    ``(length, first_rank)`` <= its own, goes to bin ``bin[i] + (r - first_rank[i]) // each[i]``
    at offset ``offset[i] + length * ((r - first_rank[i]) % each[i])``."""

    length: np.ndarray
    first_rank: np.ndarray
    bin: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.searchsorted(self.length, length, "left")
        end = np.searchsorted(self.length, length, "right")
        low, high = begin, end - 1           # the last entry of the length with first_rank <= rank
        while np.any(low < high):
            mid = (low + high + 1) // 2
            fits = self.first_rank[mid] <= rank
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        within = rank - self.first_rank[low]
        return (self.bin[low] + within // self.each[low],
                self.offset[low] + length * (within % self.each[low]))


def plan_bins(counts: dict[int, int], capacity: int = MAX_TOKENS) -> Plan:
    """Best fit decreasing for ``counts[length]`` pieces of each length.

    A group is ``(first bin, bins)`` of one remaining capacity.  A length
    takes whole groups from the tightest capacity on and splits at most the
    last one, so the plan's size depends on ``capacity`` alone, not on the
    number of pieces.
    """
    tree = CapacityTree(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}
    rows: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            groups.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        while left:
            room = tree.tightest(length)
            if room < 0:
                room = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = groups[room].pop()
                if not groups[room]:
                    tree.set(room, False)
            each = room // length            # an emptied bin is refilled before the next is opened
            full = min(n, left // each)
            rest = min(left - full * each, each) if full < n else 0
            taken = full * each + rest
            rows.append((length, rank, first, each, capacity - room))
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + (rest > 0), n - full - (rest > 0))
            left -= taken
            rank += taken
    rows.sort()
    table = np.array(rows, np.int64).reshape(len(rows), 5)
    return Plan(*(np.ascontiguousarray(table[:, i]) for i in range(5)), bins)


class WordTokenizer:
    """Token ids of whole texts, unit by unit.

    The vocabulary's pre-tokeniser drops white space, never joins across it and
    ends a unit between letters, single digits and other characters, so a
    text's ids are those of its units, one after the other.  A block of texts is
    cut into units as one byte buffer; each distinct unit is tokenised once and
    remembered.  At most ``cache_units`` are kept between blocks; when they are too
    many, the less used half goes.  Words where the units are not that plain
    (not ASCII, an apostrophe, a special token's bracket) are units as a whole.
    """

    def __init__(self, model: str | bytes, cache_units: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task is the unit of parallelism
        import tokenizers

        self.tokenizer = (tokenizers.Tokenizer.from_buffer(model) if isinstance(model, bytes)
                          else tokenizers.Tokenizer.from_file(model))
        self.cache_units = cache_units
        self.ends = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>")
                              for i in range(self.tokenizer.get_vocab_size())])

        self.known: dict[str, int] = {}      # units in the order of ``starts``
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the more used half of ``cache_units``, in order of use."""
        keep = np.argsort(-self.uses, kind="stable")[:self.cache_units // 2]
        names = list(self.known)
        size = np.diff(self.starts)[keep]
        starts = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
        self.ids = self.ids[np.repeat(self.starts[keep] - starts[:-1], size)
                            + np.arange(starts[-1])]
        self.starts = starts
        self.known = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.uses = self.uses[keep] // 2     # what was common long ago fades

    def _learn(self, units: list[str]) -> None:
        """Append the ids of ``units``: plain ones joined, the others one by one."""
        plain, rest = [], []
        for u in units:
            (plain if u.isascii() and "'" not in u and "<|" not in u else rest).append(u)
        names, flat, sizes = [], [self.ids], []
        for a in range(0, len(plain), 2000):
            some = plain[a:a + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast(
                [" ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) == len(some):
                names += some
                flat.append(ids)
                sizes.append(np.diff(ends, prepend=-1))
            else:
                rest += some
        for a in range(0, len(rest), 2000):
            some = rest[a:a + 2000]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(
                some, add_special_tokens=False)]
            names += some
            flat.append(np.fromiter(chain.from_iterable(coded), np.uint32))
            sizes.append(np.array([len(x) for x in coded], np.int64))
        self.known.update(zip(names, range(len(self.known), len(self.known) + len(names))))
        self.starts = np.concatenate(
            (self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))))
        self.ids = np.concatenate(flat)
        self.uses = np.append(self.uses, np.zeros(len(names), np.int64))

    def encode(self, column: pa.Array, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows back to back, with ``end_id`` after each, and the rows' bounds."""
        data, cuts, first = _units(Words(column, lower=False))
        coded = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.known.get, unique, repeat(-1)), np.int64, len(unique))
        new = np.flatnonzero(at < 0)
        if len(new):
            units = [unique[i] for i in new.tolist()]
            self._learn(units)
            at[new] = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        self.uses[at] += np.bincount(index, minlength=len(at))
        start, size = self.starts[at], self.starts[at + 1] - self.starts[at]
        per_unit = size[index]
        total = np.zeros(len(index) + 1, np.int64)
        np.cumsum(per_unit, out=total[1:])
        where = np.repeat(start[index] - total[:-1], per_unit) + np.arange(total[-1])
        ids = self.ids[where]
        bounds = total[first]
        if len(self.known) > self.cache_units:
            self._forget()
        if end_id is None:
            return ids, bounds
        ids = np.insert(ids, bounds[1:], np.uint32(end_id))
        return ids, bounds + np.arange(len(bounds))


def _units(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The units' bytes back to back (plain words in lower case), their bounds, and
    each row's first unit (one longer than the rows)."""
    data, begins = words.data, words.offsets[:-1]
    if not len(words):
        return data, np.zeros(1, np.int64), np.zeros(words.n_docs + 1, np.int64)
    word_start = np.zeros(len(data), bool)
    word_start[begins] = True
    odd = (data >= 128) | (data == ord("'"))
    odd[1:] |= (data[1:] == ord("|")) & (data[:-1] == ord("<")) & ~word_start[1:]
    whole = np.repeat(np.logical_or.reduceat(odd, begins), np.diff(words.offsets))
    data = np.where(whole, data, LOWER[data])
    kind = _KIND[data]
    start = np.ones(len(data), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    start &= ~whole
    start |= word_start
    cuts = np.append(np.flatnonzero(start), len(data))
    return data, cuts, np.searchsorted(cuts, words.offsets[words.first])


@lru_cache(maxsize=1)
def _coder(model: bytes) -> WordTokenizer:
    """The tokenizer of this worker, which goes on from task to task."""
    return WordTokenizer(model)


def packed_ids(ids: np.ndarray) -> bytes:
    """The bytes of ``ids`` after one for their width, by zstd where that is shorter."""
    raw = ids.tobytes()
    coded = _ZSTD.compress(raw, asbytes=True)
    if len(coded) < len(raw):
        return bytes((ids.itemsize | _CODED,)) + coded
    return bytes((ids.itemsize,)) + raw


def unpacked_ids(data, n: int) -> np.ndarray:
    """The ``n`` ids in :func:`packed_ids`'s bytes."""
    data = memoryview(data).cast("B")
    width = data[0] & ~_CODED
    raw = _ZSTD.decompress(data[1:], n * width) if data[0] & _CODED else data[1:]
    return np.frombuffer(raw, f"<u{width}", n)


def _pieces(batches, model: bytes, max_tokens: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    coder = _coder(model)
    narrow = len(coder.ends) <= 1 << 16
    for batch in batches:
        column = batch.column(2)
        for first, last in row_blocks(column, TOKENISED_BYTES):
            ids, bounds = coder.encode(column.slice(first, last - first), END_ID)
            n = np.diff(bounds)
            pieces = -(-n // max_tokens)
            row = np.repeat(np.arange(len(n)), pieces)
            begin = np.cumsum(pieces) - pieces
            piece = np.arange(len(row)) - begin[row]
            start = piece * max_tokens
            length = np.minimum(n[row] - start, max_tokens)
            at = bounds[row] + start
            little = ids.astype("<u4", copy=False)
            spans = list(zip(at.tolist(), (at + length).tolist()))
            crc = np.array([zlib.crc32(little[a:b]) for a, b in spans], np.int64)
            out = [batch.column(0).slice(first, last - first).take(pa.array(row)),
                   batch.column(1).slice(first, last - first).take(pa.array(row)),
                   pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                   pa.array(crc)]
            names = ["doc_id", "salt", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                kept = ids.astype("<u2") if narrow else little
                out.append(pa.array([packed_ids(kept[a:b]) for a, b in spans], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)


def token_pieces(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                 max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """Token ids of every text plus one end id, cut into pieces of ``max_tokens``.

    ``(doc_id, salt, piece, start, length, ids_crc32[, ids])``; ``ids`` are
    little-endian, of 2 bytes each where the vocabulary has at most 65,536
    entries, else of 4, compressed (:func:`unpacked_ids` reads them), for they are written
    three times; the crc is always that of 4 bytes each.  A null text is an empty one: its
    single piece is the end id.  ``path`` is read on the driver and sent to the tasks.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.pmod(F.xxhash64(F.col(id_col).cast("long"), text),
                              F.lit(SALTS)).cast("int").alias("salt"), text.alias("text"))
    schema = ("doc_id long, salt int, piece int, start long, length long, ids_crc32 long"
              + (", ids binary" if with_ids else ""))
    with open(path, "rb") as file:         # some megabytes, whatever the input
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    return rows.transform(
        in_tasks, lambda it: _pieces(it, model.value, max_tokens, with_ids), schema)


def place_pieces(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` (already saved) with ``sequence_id`` and ``offset``.

    Every sequence is filled from offset 0 without gaps.  The only thing that
    reaches the driver is the number of pieces of each length.
    """
    counts = saved(pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    plan = plan_bins({r["length"]: r["n"] for r in counts.groupBy("length")
                      .agg(F.sum("n").alias("n")).collect()}, max_tokens)
    sent = pieces.sparkSession.sparkContext.broadcast(plan)
    before = counts.select("length", "salt", (
        F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy(
        F.col("doc_id").asc_nulls_last(), "piece", "start", "ids_crc32")
    ranked = (pieces.withColumn("rank", F.row_number().over(order))
              .join(before, ["length", "salt"])
              .withColumn("rank", F.col("rank") + F.col("base") - 1).drop("base"))

    def put(batches):
        for batch in batches:
            bins, offset = sent.value.place(
                batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            names = batch.schema.names
            keep = [i for i, c in enumerate(names) if c not in ("rank", "salt")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(bins), pa.array(offset)],
                names=[names[i] for i in keep] + ["sequence_id", "offset"])

    kept = [f"`{n}` {t}" for n, t in ranked.dtypes if n not in ("rank", "salt")]
    return ranked.transform(in_tasks, put, ", ".join(kept) + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                   max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    A document is its token ids and an end id; only documents longer than
    ``max_tokens`` are cut, losslessly, and their last piece may be shorter.
    An empty or null text is the end id alone.  Repeated rows and equal lengths
    are placed in a fixed order (by id); rows without an id come last.  An
    empty table packs into nothing.  Other columns of ``docs`` play no part.
    """
    pieces = saved(token_pieces(docs, path, text_col, id_col, max_tokens))
    return place_pieces(pieces, max_tokens)
