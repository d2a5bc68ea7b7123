"""Exact duplicates by Grace hash partitioning.

Equal texts are found by comparing complete content.  The work is one Spark
shuffle on the text's hash between two passes of the same table:

* before the shuffle every input partition merges its own equal texts, so a
  text that a third of the rows hold crosses the network once per partition;
* after it, each partition merges what the others sent.

A partition (either side) whose distinct texts exceed ``budget`` bytes is
partitioned again, by further bits of the hash, into spill files in the task's
own scratch folder; each file is read back and, if it still does not fit, is
partitioned again.  What fits goes into an open-addressing table that probes
by hash and compares whole contents.  Spill files belong to the task: they are
deleted when it ends and made again if it is retried elsewhere.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks

# Bytes of distinct texts that a task's table may hold before it spills.
TABLE_BYTES = 64 << 20
FANOUT = 16                      # spill files per level: four more bits of the hash
_HEAD = struct.Struct("<Qqqbq")  # hash, largest id, rows, has an id, bytes of the text

Record = tuple[int, bytes, int | None, int]  # hash, text, largest id, rows


class ContentTable:
    """Open addressing with linear probing; keys are whole texts.

    The slots hold entry numbers; a probe compares hashes first and contents
    on a match, so texts of equal hash stay apart.
    """

    def __init__(self) -> None:
        self.slots = np.full(1 << 10, -1, np.int64)
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, h: int, text: bytes, top: int | None, rows: int) -> None:
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (i := slots[at]) >= 0:
            e = self.entries[i]
            if e[0] == h and e[1] == text:
                if top is not None and (e[2] is None or top > e[2]):
                    e[2] = top
                e[3] += rows
                return
            at = (at + 1) & mask
        slots[at] = len(self.entries)
        self.entries.append([h, text, top, rows])
        self.bytes += len(text) + 120
        if 2 * len(self.entries) > len(slots):
            self._grow()

    def _grow(self) -> None:
        size = 2 * len(self.slots)
        self.slots = np.full(size, -1, np.int64)
        for i, e in enumerate(self.entries):
            at = e[0] & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = i


def grace(records: Iterable[Record], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """Merge records of equal text: yields one record per distinct text.

    Holds at most about ``budget`` bytes of texts plus one text; the rest waits
    in spill files.  Past the hash's last bits (texts of one and the same hash)
    the table is used whatever its size, since no further split exists.
    """
    table, shift = ContentTable(), 60 - 4 * level
    records = iter(records)
    for h, text, top, rows in records:
        table.add(h, text, top, rows)
        if table.bytes > budget and len(table.entries) > 1 and shift >= 0:
            break
    else:
        for h, text, top, rows in table.entries:
            yield h, text, top, rows
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        names = [os.path.join(folder, str(i)) for i in range(FANOUT)]
        files = [open(name, "wb") for name in names]
        try:
            for source in (table.entries, records):
                for h, text, top, rows in source:
                    out = files[(h >> shift) & (FANOUT - 1)]
                    out.write(_HEAD.pack(h, top or 0, rows, top is not None, len(text)))
                    out.write(text)
        finally:
            for f in files:
                f.close()
        del table
        for name in names:
            yield from grace(_read(name), budget, level + 1)
            os.unlink(name)


def _read(name: str) -> Iterator[Record]:
    with open(name, "rb") as f:
        while head := f.read(_HEAD.size):
            h, top, rows, known, size = _HEAD.unpack(head)
            yield h, f.read(size), top if known else None, rows


def _merge(batches: Iterable[pa.RecordBatch], budget: int, final: bool) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[Record]:
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            for h, text, top, rows in zip(hashes.tolist(), batch.column(1),
                                          batch.column(2).to_pylist(),
                                          batch.column(3).to_pylist()):
                yield h, text.as_buffer().to_pybytes(), top, rows

    out: list[tuple] = []
    size = 0
    for h, text, top, rows in grace(records(), budget):
        out.append((h, hashlib.sha256(text).hexdigest() if final else text, top, rows))
        size += 100 if final else len(text)
        if size > 8 << 20:
            yield _batch(out, final)
            out, size = [], 0
    if out:
        yield _batch(out, final)


def _batch(rows: list[tuple], final: bool) -> pa.RecordBatch:
    h, text, top, n = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(h, np.uint64).view(np.int64)),
         pa.array(text, pa.string() if final else pa.binary()),
         pa.array(top, pa.int64()), pa.array(n, pa.int64())],
        names=["h", "text_sha256" if final else "text", "keep_id", "group_size"])


def content_groups(docs: DataFrame, text: Column, doc_id: Column,
                   budget: int = TABLE_BYTES) -> DataFrame:
    """``(text_sha256, keep_id, group_size)``, one row per distinct text."""
    rows = docs.select(F.xxhash64(text).alias("h"), F.encode(text, "UTF-8").alias("text"),
                       doc_id.cast("long").alias("keep_id"),
                       F.lit(1).cast("long").alias("group_size"))
    local = rows.transform(in_tasks, lambda it: _merge(it, budget, False),
                            "h long, text binary, keep_id long, group_size long")
    return (local.repartition("h")
            .transform(in_tasks, lambda it: _merge(it, budget, True),
                        "h long, text_sha256 string, keep_id long, group_size long")
            .select("text_sha256", "keep_id", "group_size"))


def mark_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    budget: int = TABLE_BYTES) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical; a null text counts as empty.  Of equal
    texts the row with the largest id stays.  A row without an id stays only
    if its whole group has none.  Repeated rows (equal id and text) are one
    document: each of them is marked alike, :func:`drop_duplicates` leaves one.
    An empty table gives an empty result.  Columns of ``docs`` with the names
    of the added columns are replaced.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    groups = content_groups(docs, text, F.col(id_col), budget)
    # copies join on the digest of their text; a digest held by a third of the
    # rows is on the left side of an outer join, which AQE splits
    marked = docs.drop(*added).withColumn("text_sha256", F.sha2(F.encode(text, "UTF-8"), 256))
    return (marked.join(groups, "text_sha256", "left")
            .withColumn("kept", F.col(id_col).cast("long").eqNullSafe(F.col("keep_id")))
            .select(*[marked[c] for c in docs.columns if c not in added], *added))


def drop_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    budget: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with its own columns."""
    marked = mark_duplicates(docs.select(id_col, text_col), text_col, id_col, budget)
    one = (marked.where("kept").select(id_col, "text_sha256").distinct())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn("__sha", F.sha2(F.encode(text, "UTF-8"), 256))
    keys = one.select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__key"))
    stay = keyed.join(keys, (keyed["__sha"] == keys["__key"])
                      & keyed[id_col].eqNullSafe(keys["__id"]), "left_semi")
    # repeated rows (equal id and text) are one document
    return stay.dropDuplicates([id_col, "__sha"]).select(*docs.columns)
