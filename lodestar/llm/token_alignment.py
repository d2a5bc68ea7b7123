"""Alignment of two tokenizers over a corpus, with corpus-wide link counts.

Both tokenizers cut the same bytes (a space and the text).  Two tokens are
linked where their byte ranges overlap, and a pair of ids counts how many links
of the whole corpus hold it; a link is a best one if its count is the highest
of its B id.

The counting is external.  While tokenising, a task sorts the (pair, document)
records of some million links by B id, A id and document, and writes them as
one zstd run for each radix of the B id.  Runs lie in a table in the shared
checkpoint folder, so nothing of them is held or lost with an executor:

* the runs' heads (pairs and their totals) of one radix are merged with a heap,
  in the order of B ids, which counts each pair; a radix with many bytes is
  merged in slices of ``SLICE_BYTES``, whose counts Spark sums;
* the runs are read once more against their radix' counts, again in the order
  of B ids.  A B id's highest count stands beside its pairs, so each run sends
  back, for every document in it, the number of best links and the sum of the
  counts, as one zstd block;
* the blocks of a flush are added up and joined to its documents.

Both tokenizers cut at a space after a plain character, so a text is handled as
units, and tokens, links and groups of a unit are found once in a task.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm._blocks import pack, unpack
from lodestar.llm._spark import groups, in_tasks
from lodestar.llm._text import row_blocks, utf8_parts
from lodestar.session import ensure_checkpoint_dir

RADIXES = 64
FLUSH_LINKS = 2_000_000
DOC_BITS = 20
SLICE_BYTES = 16 << 20
CACHE_UNITS = 400_000
CHUNK_BYTES = 4096

# How the byte-level tokenizer cuts text before merging, the printable
# characters that stand for themselves in its entries (the other bytes follow from
# U+0100 on), and the mark that stands for a space in the other's pieces.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PRINTABLE = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
SPACE_MARK = "▁"


def _byte_letters() -> dict[str, int]:
    own = [b for low, high in PRINTABLE for b in range(low, high + 1)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteTokenizer:
    """The byte-level BPE of a ``tokenizers`` file, read as ranks: its merges are
    numbered in the order in which they apply."""

    def __init__(self, definition: bytes):
        import tiktoken

        model = json.loads(definition)["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        letters = _byte_letters()
        vocab = model["vocab"]
        if [vocab["".join(m)] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("the entries are not numbered in the order of their merges")
        ranks = {bytes(letters[c] for c in entry): i for entry, i in vocab.items()
                 if i < 256 + len(merges)}
        self.size = 1 + max(ranks.values())
        self.width = np.zeros(self.size, np.int64)
        for entry, i in ranks.items():
            self.width[i] = len(entry)
        self.coder = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks,
                                       special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.coder.encode_ordinary(text), np.int64)


class PieceTokenizer:
    """A ``sentencepiece`` model that puts a space before a text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.size = self.coder.get_piece_size()
        self.bytes = []
        for i in range(self.size):
            piece = self.coder.id_to_piece(i)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if self.coder.is_byte(i)
                              else piece.replace(SPACE_MARK, " ").encode())
        self.width = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the space which the model adds."""
        return self.coder.encode([t[1:] for t in texts], num_threads=1)


class Aligned(NamedTuple):
    """The units of a block of texts."""
    unit: np.ndarray        # their numbers in the aligner's tables, in order
    first: np.ndarray       # each row's first unit (one longer than the rows)


class Aligner:
    """Tokens, links and groups of units; the known ones are remembered.

    ``cache_units`` bounds the memory: beyond it all are forgotten.
    """

    def __init__(self, a: bytes, b: bytes, cache_units: int = CACHE_UNITS):
        self.a, self.b = ByteTokenizer(a), PieceTokenizer(b)
        self.a_bits = max(1, (self.a.size - 1).bit_length())
        self.cache_units = cache_units
        self.numbers = pa.array([f"{i}{mark}" for i in range(max(self.a.size, self.b.size))
                                 for mark in ",|;"], pa.large_string())
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.groups = pa.array([], pa.large_string())
        self.counts = np.zeros((0, 4), np.int64)      # A, B, groups, unlike bytes
        self.starts = np.zeros(1, np.int64)
        self.links = np.zeros(0, np.int64)

    def rows(self, column: pa.Array) -> Aligned:
        """Look up the units of texts (each with the space before it)."""
        data, bounds = utf8_parts(column)
        cuts = _unit_bounds(data, bounds)
        coded = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data)))
        coded = coded.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [u for u in distinct if u not in self.known]
        if new and len(self.known) + len(new) > self.cache_units:
            self._forget()
            new = distinct
        if new:
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return Aligned(at[coded.indices.to_numpy()], np.searchsorted(cuts, bounds))

    def _learn(self, new: list[str]) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        sizes = np.array([len(u.encode()) for u in new], np.int64)
        odd = np.array([SPACE_MARK in u for u in new], bool)
        a, b = self._tokens([u for u, x in zip(new, odd) if not x])
        ends = np.cumsum(sizes[~odd])
        a_end, b_end = np.cumsum(self.a.width[a]), np.cumsum(self.b.width[b])
        every = np.sort(np.concatenate((a_end, b_end)))
        again = np.zeros(len(every), bool)
        again[1:] = every[1:] == every[:-1]
        end, both = every[~again], every[again]
        # between two neighbouring ends lies the overlap of exactly one A and one B token
        a_at, b_at = np.searchsorted(a_end, end), np.searchsorted(b_end, end)
        links = b[b_at] << self.a_bits | a[a_at]
        counts = np.zeros((len(new), 4), np.int64)
        counts[:, 3] = odd
        for k, x in enumerate((a_end, b_end, both)):
            counts[~odd, k] = np.diff(np.searchsorted(x, ends, "right"), prepend=0)
        per_unit = np.zeros(len(new), np.int64)
        per_unit[~odd] = np.diff(np.searchsorted(end, ends, "right"), prepend=0)
        texts = self._group_texts(a, b, np.searchsorted(both, a_end), np.searchsorted(both, b_end),
                                  counts[:, 0] + counts[:, 1])
        self.groups = pa.concat_arrays([self.groups, texts])
        self.counts = np.concatenate((self.counts, counts))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(per_unit)))
        self.links = np.concatenate((self.links, links))

    def _tokens(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A and B ids of units back to back.

        Units are coded as one text as long as each ends with a character after
        which both tokenizers cut at the next unit's space.
        """
        texts, held, size = [], [], 0
        for u in new:
            held.append(u)
            size += len(u)
            if size >= CHUNK_BYTES or not ("!" <= u[-1] <= "~" or "\u00c0" <= u[-1] <= "\u07ff"):
                texts.append("".join(held))
                held, size = [], 0
        if held:
            texts.append("".join(held))
        a = [self.a.encode(t) for t in texts]
        b = [np.array(x, np.int64) for x in self.b.encode(texts)]
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *a]), np.concatenate([none, *b])
        total = sum(len(t.encode()) for t in texts)
        if self.a.width[a].sum() != total or self.b.width[b].sum() != total:
            raise ValueError("a tokenizer does not keep the bytes of plain text")
        return a, b

    def _group_texts(self, a, b, a_group, b_group, per_unit) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3;`` of every unit: ids with the mark after each, in order."""
        last_a = np.append(a_group[1:] != a_group[:-1], True) if len(a) else a_group > 0
        last_b = np.append(b_group[1:] != b_group[:-1], True) if len(b) else b_group > 0
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")] = 3 * a + last_a
        written[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = 3 * b + 2 * last_b
        data, bounds = _joined(self.numbers.take(pa.array(written)))
        cuts = bounds[np.concatenate(([0], np.cumsum(per_unit)))]
        return pa.LargeStringArray.from_buffers(len(per_unit), pa.py_buffer(cuts), data)


def _joined(values: pa.Array):
    """The bytes of an array of strings as one buffer, and their bounds."""
    bounds = np.frombuffer(values.buffers()[1], np.int64)[
        values.offset:values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return values.buffers()[2] or pa.py_buffer(b""), bounds


def _unit_bounds(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bounds of the units: rows' starts, and spaces after a plain ASCII character or
    a two-byte letter (none of which is white space in any alphabet)."""
    if not len(data):
        return np.zeros(1, np.int64)
    solid = (data > 0x20) & (data < 0x7F)
    solid[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    start = np.zeros(len(data), bool)
    start[1:] = (data[1:] == 0x20) & solid[:-1]
    start[rows[:-1][np.diff(rows) > 0]] = True
    return np.append(np.flatnonzero(start), len(data))


def sorted_runs(links: np.ndarray, docs: np.ndarray, a_bits: int):
    """``(radix, head, body)`` of a flush: records in the order of B id, A id and document.

    ``links`` are ``b << a_bits | a``.  The head has the pairs' steps, numbers of
    documents and links, the body the steps of the documents and the links of
    each.
    """
    b = links >> a_bits
    quotient_bits = max(1, int(b.max(initial=0) // RADIXES).bit_length())
    pair = (b // RADIXES) << a_bits | links & ((1 << a_bits) - 1)
    key = ((b % RADIXES) << (quotient_bits + a_bits) | pair) << DOC_BITS | docs
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(key)))
    key = key[at]
    doc, pair = key & ((1 << DOC_BITS) - 1), key >> DOC_BITS
    radix = pair >> (quotient_bits + a_bits)
    pair &= (1 << (quotient_bits + a_bits)) - 1
    bounds = np.searchsorted(radix, np.arange(RADIXES + 1))
    for r in np.flatnonzero(np.diff(bounds)).tolist():
        of = slice(bounds[r], bounds[r + 1])
        p, d, t = pair[of], doc[of], times[of]
        first = np.flatnonzero(np.diff(p, prepend=-1))
        steps = np.diff(d, prepend=0)
        steps[first] = d[first]
        head = pack([np.diff(p[first], prepend=0), np.diff(np.append(first, len(p))),
                     np.add.reduceat(t, first)])
        yield r, head, pack([steps, t])


def read_head(head: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (in order), their numbers of documents and of links."""
    steps, documents, links = unpack(head)
    return np.cumsum(steps), documents, links


def read_body(body: bytes, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and links of every record of a run."""
    steps, times = unpack(body)
    total = np.cumsum(steps)
    first = np.cumsum(documents) - documents
    before = total[first] - steps[first]
    return total - np.repeat(before, documents), times


def merged(heads: list[tuple[np.ndarray, np.ndarray]], a_bits: int):
    """k-way merge of runs ``(pairs, links)`` by a heap on their next B id:
    ``(b quotient, A ids, counts)`` in the order of B ids."""
    runs = []
    for pairs, links in heads:
        b = pairs >> a_bits
        cuts = np.append(np.flatnonzero(np.diff(b, prepend=-1)), len(b))
        runs.append((b[cuts[:-1]].tolist(), cuts.tolist(), pairs & ((1 << a_bits) - 1), links))
    heap = [(run[0][0], i, 0) for i, run in enumerate(runs) if run[0]]
    heapq.heapify(heap)
    while heap:
        b = heap[0][0]
        ids, counts = [], []
        while heap and heap[0][0] == b:
            _, i, k = heap[0]
            names, cuts, a, links = runs[i]
            ids.append(a[cuts[k]:cuts[k + 1]])
            counts.append(links[cuts[k]:cuts[k + 1]])
            if k + 1 < len(names):
                heapq.heapreplace(heap, (names[k + 1], i, k + 1))
            else:
                heapq.heappop(heap)
        a, counts = np.concatenate(ids), np.concatenate(counts)
        order = np.argsort(a, kind="stable")
        a, counts = a[order], counts[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        yield b, a[first], np.add.reduceat(counts, first)


_STORED = ("flush long, local int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups string, radix int, head binary, body binary")
_NAMES = [c.split()[0] for c in _STORED.split(", ")]


class _Flush:
    """Records of some documents of a task, until they are written as runs."""

    def __init__(self):
        self.id, self.docs, self.size = None, 0, 0
        self.links: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []

    def runs(self, a_bits: int):
        out = list(sorted_runs(np.concatenate(self.links), np.concatenate(self.owners),
                               a_bits)) if self.size else []
        if out:
            n = len(out)
            columns = [pa.array([self.id] * n, pa.int64()), pa.nulls(n, pa.int32()),
                       *[pa.nulls(n, pa.int64())] * 5, pa.nulls(n, pa.string()),
                       pa.array([r for r, _, _ in out], pa.int32()),
                       pa.array([h for _, h, _ in out], pa.binary()),
                       pa.array([x for _, _, x in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _aligned(batches, a: bytes, b: bytes, hashed: bool):
    """Documents' own columns and the runs of their records, as rows of one table."""
    aligner, flush = Aligner(a, b), _Flush()
    for batch in batches:
        texts = batch.column(2)
        for first, last in row_blocks(texts):
            if flush.size >= FLUSH_LINKS or flush.docs + last - first > 1 << DOC_BITS:
                yield from flush.runs(aligner.a_bits)
                flush = _Flush()
            part = batch.slice(first, last - first)
            if flush.id is None:
                flush.id = part.column(0)[0].as_py()
            yield _documents(aligner, flush, part, hashed)
    yield from flush.runs(aligner.a_bits)


def _documents(aligner: Aligner, flush: _Flush, part: pa.RecordBatch, hashed: bool):
    texts, n = part.column(2), part.num_rows
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    spaced = pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar(""))
    unit, first = aligner.rows(spaced)
    per_unit = np.concatenate((aligner.counts[unit],
                               np.diff(aligner.starts)[unit][:, None]), 1)
    totals = np.zeros((len(unit) + 1, 5), np.int64)
    np.cumsum(per_unit, axis=0, out=totals[1:])
    totals = totals[first[1:]] - totals[first[:-1]]
    none = empty | (totals[:, 3] > 0)
    totals[none] = 0
    owner = np.repeat(np.arange(n), np.diff(first))
    good = ~none[owner]
    at, owner = unit[good], owner[good]
    size = aligner.starts[at + 1] - aligner.starts[at]
    end = np.cumsum(size)
    where = np.repeat(aligner.starts[at] - end + size, size) + np.arange(size.sum())
    flush.links.append(aligner.links[where])
    flush.owners.append(np.repeat(owner, size) + flush.docs)
    data, bounds = _joined(aligner.groups.take(pa.array(unit)))
    data, bounds = memoryview(data), bounds[first].tolist()
    texts = ["" if skip else hashlib.sha256(data[x:y - 1]).hexdigest() if hashed
             else bytes(data[x:y - 1]).decode()
             for skip, x, y in zip(none.tolist(), bounds, bounds[1:])]
    columns = [pa.array([flush.id] * n, pa.int64()),
               pa.array(np.arange(flush.docs, flush.docs + n, dtype=np.int32)), part.column(1),
               *[pa.array(totals[:, k]) for k in (0, 1, 2, 4)], pa.array(texts, pa.string()),
               pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())]
    flush.docs += n
    flush.size += int(size.sum())
    return pa.RecordBatch.from_arrays(columns, names=_NAMES)


def _counted(batches, a_bits: int):
    """Pair counts of every (radix, slice)."""
    for (radix, _), parts in groups(batches, ["radix", "slice"]):
        heads = [read_head(h.as_py())[::2] for p in parts for h in p.column("head")]
        b, a, n, held = [], [], [], 0
        for quotient, ids, counts in merged(heads, a_bits):
            b.append(np.full(len(ids), quotient * RADIXES + radix, np.int32))
            a.append(ids)
            n.append(counts)
            held += len(ids)
            if held >= 100_000:
                yield _pair_batch(b, a, n)
                b, a, n, held = [], [], [], 0
        if held:
            yield _pair_batch(b, a, n)


def _pair_batch(b, a, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(b)), pa.array(np.concatenate(a).astype(np.int32)),
         pa.array(np.concatenate(n))], names=["b_id", "a_id", "n"])


def _contributions(batches, a_bits: int):
    """For each run the best links and summed counts of its documents (a group's counts,
    in the order of B ids, come before its runs)."""
    for _, parts in groups(batches, ["radix", "slice"]):
        keys, counts, best = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for p in parts:
            for b, pairs, top in zip(*(p.column(c) for c in ("b_id", "pairs", "top"))):
                if not b.is_valid:
                    continue
                n = pairs.values.field("n").to_numpy()
                keys.append((b.as_py() // RADIXES << a_bits)
                            | pairs.values.field("a_id").to_numpy().astype(np.int64))
                counts.append(n)
                best.append(n == top.as_py())
        keys, counts, best = map(np.concatenate, (keys, counts, best))
        for p in parts:
            for flush, head, body in zip(*(p.column(c) for c in ("flush", "head", "body"))):
                if not head.is_valid:
                    continue
                pairs, documents, _ = read_head(head.as_py())
                doc, times = read_body(body.as_py(), documents)
                at = np.searchsorted(keys, pairs)
                low = int(doc.min())
                sums = np.zeros((2, int(doc.max()) + 1 - low), np.int64)
                np.add.at(sums[0], doc - low, times * np.repeat(best[at], documents))
                np.add.at(sums[1], doc - low, times * np.repeat(counts[at], documents))
                some = np.flatnonzero(sums[1])
                blob = pack([np.diff(some + low, prepend=0), sums[0][some], sums[1][some]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([flush.as_py()]), pa.array([blob], pa.binary())],
                    names=["flush", "block"])


def _summed(batches):
    """The blocks of each flush added up, one row per document."""
    for (flush,), parts in groups(batches, ["flush"]):
        sums = np.zeros((2, 0), np.int64)
        for p in parts:
            for block in p.column("block"):
                steps, best, total = unpack(block.as_py())
                doc = np.cumsum(steps)
                if doc[-1] >= sums.shape[1]:
                    sums = np.pad(sums, ((0, 0), (0, int(doc[-1]) + 1 - sums.shape[1])))
                sums[0][doc] += best
                sums[1][doc] += total
        some = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), flush)), pa.array(some.astype(np.int32)),
             pa.array(sums[0][some]), pa.array(sums[1][some])],
            names=["flush", "local", "n_best", "count_sum"])


class Alignment(NamedTuple):
    """What :func:`align` returns."""
    documents: DataFrame
    pairs: DataFrame


def _file(spark: SparkSession, path: str) -> bytes:
    """A tokenizer's file (some megabytes), read where the driver runs."""
    with open(path, "rb") as f:
        return f.read()


def align(docs: DataFrame, byte_path: str, piece_path: str, text_col: str = "text",
          id_col: str = "doc_id", hashed: bool = False) -> Alignment:
    """Align tokenizers A (``byte_path``) and B (``piece_path``) on all texts.

    ``documents``: ``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups)``, one row per row of ``docs``.  ``groups`` is ``a1,a2|b1;a3|b2,b3``
    in ids, or with ``hashed`` its sha256.  ``pairs``: ``(b_id, a_id, n, best)``,
    the links of the whole corpus by pair.

    Null and empty texts, and texts whose token bytes differ from the text (a
    U+2581 in it, which B takes for a space), have zeros and ``''``.  Repeated
    rows count as often as they occur, rows without an id like others; equal
    counts are all best.  An empty table gives two empty ones.  Texts of any
    length are handled whole.  Other columns play no part.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((_file(spark, byte_path), _file(spark, piece_path)))
    probe = Aligner(*sent.value)
    a_bits = probe.a_bits
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    in_tasks(rows, lambda it: _aligned(it, *sent.value, hashed), _STORED).write.parquet(
        f"{folder}/stored")
    stored = spark.read.schema(_STORED).parquet(f"{folder}/stored")

    # slices of a radix: at most RADIXES rows are joined to the runs
    runs = stored.where("radix IS NOT NULL")
    slices = F.broadcast(runs.groupBy("radix").agg(
        F.ceil(F.sum(F.length("head") + F.length("body")) / SLICE_BYTES).cast("int").alias("slices")))
    sliced = (runs.join(slices, "radix")
              .withColumn("slice", F.pmod(F.xxhash64("flush"), F.col("slices")).cast("int")))
    heads = (sliced.select("radix", "slice", "head").repartition("radix", "slice")
             .sortWithinPartitions("radix", "slice"))
    in_tasks(heads, lambda it: _counted(it, a_bits), "b_id int, a_id int, n long").groupBy(
        "b_id", "a_id").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/pairs")
    pairs = spark.read.schema("b_id int, a_id int, n long").parquet(f"{folder}/pairs")

    # one row per B id (at most a vocabulary of pairs), beside every slice of its radix
    sides = (pairs.groupBy("b_id").agg(
        F.sort_array(F.collect_list(F.struct("a_id", "n"))).alias("pairs"), F.max("n").alias("top"))
        .withColumn("radix", (F.col("b_id") % RADIXES).cast("int")).join(slices, "radix")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    both = (sides.select("radix", "slice", "b_id", "pairs", "top")
            .unionByName(sliced.select("radix", "slice", "flush", "head", "body"),
                         allowMissingColumns=True)
            .repartition("radix", "slice").sortWithinPartitions("radix", "slice", "b_id"))
    blocks = in_tasks(both, lambda it: _contributions(it, a_bits), "flush long, block binary")
    sums = in_tasks(blocks.repartition("flush").sortWithinPartitions("flush"), _summed,
                    "flush long, local int, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    documents = (stored.where("radix IS NULL").drop("radix", "head", "body")
                 .join(sums, ["flush", "local"], "left")
                 .select("doc_id", "n_a", "n_b", "n_groups", "n_links",
                         F.coalesce("n_best", zero).alias("n_best"),
                         F.coalesce("count_sum", zero).alias("count_sum"), "groups"))
    top = pairs.groupBy("b_id").agg(F.max("n").alias("top"))
    best = pairs.join(top, "b_id").select("b_id", "a_id", "n",
                                          (F.col("n") == F.col("top")).alias("best"))
    return Alignment(documents, best)
