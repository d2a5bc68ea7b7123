"""Long passages that occur more than once, by a compacted De Bruijn graph of words.

The edges of the graph are windows of ``WINDOW`` consecutive words.  An edge
that two places share is a repeated window, and repeated passages are paths of
such edges.  Writing every edge out would take several times the corpus, so the
graph is built compacted:

1. In each window the least hash of its ``ANCHOR``-word runs is the window's
   anchor; the choice depends on the window's words alone, so equal windows
   have equal anchors.  Consecutive windows with one anchor occurrence form a
   nonbranching path, kept as one record: anchor, hash of all its words, place.
2. Grouped by anchor, paths with equal words are repeated as a whole: all
   their windows are.  An anchor that occurs once cannot be in a repeated
   window.  Only an anchor with differing paths is a branching place.
3. The windows of branching paths are written out one by one and joined on
   anchor and window hash (128 bits in all); windows found twice are repeated.
4. Source coordinates (text, first word, number of windows) bring both kinds
   back to their texts, where the covered words are removed.

A bounded bitmap of branching anchors spares step 3 the paths of all others; it
can only let too many through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm._spark import bitmap, in_bitmap, in_tasks, longs, saved
from lodestar.llm._text import Runs, Words, row_blocks

WINDOW = 35
ANCHOR = 10
KEY = ["key", "key2"]
_PLACE_BITS = 8    # a path has at most WINDOW - ANCHOR + 1 windows


def _anchors(h: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost least value of every ``span`` consecutive ones."""
    n = len(h) - span + 1
    at, width = np.arange(len(h)), 1
    while 2 * width <= span:
        left, right = at[:-width], at[width:]
        at = np.where(h[right] < h[left], right, left)
        width *= 2
    left, right = at[:n], at[span - width:span - width + n]
    return np.where(h[right] < h[left], right, left)


class Paths:
    """The paths of a block of texts: anchor hash, word hash, text, place."""

    def __init__(self, column: pa.Array, window: int, anchor: int):
        words = Words(column, lower=False)
        n = len(words)
        self.words = words
        if n < window:
            self.start = self.size = self.anchor = self.doc = np.zeros(0, np.int64)
            return
        h = words.hashes()
        place = np.arange(n - anchor + 1)
        grams = Runs(h, "other").of(place, place + anchor)
        self.runs = Runs(h, "word")
        windows = np.arange(n - window + 1)
        inside = words.doc[windows] == words.doc[windows + window - 1]
        chosen = _anchors(grams, window - anchor + 1)
        windows, chosen = windows[inside], chosen[inside]
        new = np.ones(len(windows), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1)
        first = np.flatnonzero(new)
        self.start = windows[first]
        self.size = np.diff(np.append(first, len(windows)))
        self.anchor = grams[chosen[first]]
        self.doc = words.doc[self.start]

    def place(self, start: np.ndarray, doc: np.ndarray, size) -> np.ndarray:
        """Source coordinates within a text: first word and number of windows."""
        return ((start - self.words.first[doc]) << _PLACE_BITS) | size


def _keys(batch: pa.RecordBatch, rows: np.ndarray) -> list[pa.Array]:
    """Both halves of the rows' keys."""
    at = pa.array(rows)
    return [batch.column(0).take(at), batch.column(1).take(at)]


def _paths(batches, window: int, anchor: int):
    for batch in batches:
        column = batch.column(2)
        for first, last in row_blocks(column):
            p = Paths(column.slice(first, last - first), window, anchor)
            if len(p.start):
                text = p.runs.of(p.start, p.start + p.size + window - 1)
                yield pa.RecordBatch.from_arrays(
                    [longs(p.anchor), longs(text), *_keys(batch, first + p.doc),
                     pa.array(p.place(p.start, p.doc, p.size))],
                    names=["anchor", "h", "key", "key2", "place"])


def _windows(batches, window: int, anchor: int, branching):
    """The single windows of every path whose anchor may branch."""
    packed = branching.value
    for batch in batches:
        column = batch.column(2)
        for first, last in row_blocks(column):
            p = Paths(column.slice(first, last - first), window, anchor)
            if not len(p.start):
                continue
            hit = in_bitmap(packed, p.anchor)
            size = p.size[hit]
            begin = np.cumsum(size) - size
            start = np.repeat(p.start[hit] - begin, size) + np.arange(size.sum())
            doc = np.repeat(p.doc[hit], size)
            if len(start):
                yield pa.RecordBatch.from_arrays(
                    [longs(np.repeat(p.anchor[hit], size)),
                     longs(p.runs.of(start, start + window)), *_keys(batch, first + doc),
                     pa.array(p.place(start, doc, 1))],
                    names=["anchor", "h", "key", "key2", "place"])


def _remove(batches, window: int, texts: bool):
    """Words left of every text without those that its repeated windows cover."""
    for batch in batches:
        column, places = batch.column(1), batch.column(2)
        for first, last in row_blocks(column):
            words = Words(column.slice(first, last - first), lower=False)
            n = last - first
            part = places.slice(first, n)
            flat = part.flatten().to_numpy(zero_copy_only=False)
            count = pc.list_value_length(part).fill_null(0).to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(n), count)
            cover = np.zeros(len(words) + 1, np.int64)
            if len(flat):
                start = words.first[doc] + (flat >> _PLACE_BITS)
                end = start + (flat & ((1 << _PLACE_BITS) - 1)) + window - 1
                np.add.at(cover, start, 1)
                np.add.at(cover, end, -1)
            covered = np.cumsum(cover[:-1]) > 0
            removed = np.bincount(words.doc[covered], minlength=n)
            data, offsets = words.data.tobytes(), words.offsets
            kept = []
            for i in range(n):
                a, b = int(words.first[i]), int(words.first[i + 1])
                at = np.arange(a, b)[~covered[a:b]]
                kept.append(b" ".join([data[x:y] for x, y in zip(
                    offsets[at].tolist(), offsets[at + 1].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), pa.array(words.counts), pa.array(removed),
                 pa.array([k.decode() for k in kept] if texts
                          else [hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])


def _keyed(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("*", F.xxhash64("doc_id", "text").alias("key"),
                       F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text")).alias("key2"))


def repeated_windows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                     window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(key, key2, place)``: repeated windows by source coordinates.

    ``key`` and ``key2`` are 128 bits of id and text; ``place`` is the first window's first word,
    shifted by 8 bits, and the number of windows from there on.
    """
    if window - anchor + 1 >= 1 << _PLACE_BITS:
        raise ValueError("a path's windows must fit the place's low bits")
    texts = _keyed(docs, text_col, id_col).select(*KEY, "text")
    schema = "anchor long, h long, key long, key2 long, place long"
    by_anchor = Window.partitionBy("anchor")
    by_path = Window.partitionBy("anchor", "h")
    paths = saved(texts.transform(in_tasks, lambda it: _paths(it, window, anchor), schema)
                  .withColumn("m", F.count(F.lit(1)).over(by_anchor)).where("m > 1")
                  .withColumn("again", F.count(F.lit(1)).over(by_path) > 1)
                  .select("anchor", *KEY, "place", "again"))
    branching = docs.sparkSession.sparkContext.broadcast(
        bitmap(paths.where("NOT again").select("anchor").distinct(), "anchor"))
    single = (texts.transform(in_tasks, lambda it: _windows(it, window, anchor, branching), schema)
              .withColumn("m", F.count(F.lit(1)).over(by_path)).where("m > 1"))
    return paths.where("again").select(*KEY, "place").union(single.select(*KEY, "place"))


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   window: int = WINDOW, anchor: int = ANCHOR, texts: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` of every row of ``docs``.

    Words are runs of anything but white space, unchanged.  Every word that is
    covered by a window of ``window`` words whose sequence also starts anywhere
    else (in the same text included) is removed; windows are judged on the
    input.  ``kept`` is the words left, joined by one space, or their SHA-256
    with ``texts=False``.  A null text has no words; a text shorter than a
    window keeps all.  Repeated rows repeat each other, so their windows go in
    all of them.  An empty table gives an empty result; other columns play no part.
    """
    rows = _keyed(docs, text_col, id_col)
    # a set: repeated rows share their key and state the same places
    places = (repeated_windows(docs, text_col, id_col, window, anchor)
              .groupBy(*KEY).agg(F.collect_set("place").alias("places")))
    return (rows.join(places, KEY, "left").select("doc_id", "text", "places")
            .transform(in_tasks, lambda it: _remove(it, window, texts),
                        "doc_id long, n_words long, n_removed long, kept string"))
