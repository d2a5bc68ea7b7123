"""Whole-text helpers for Arrow tasks: words, hashes and n-grams as numpy arrays.

Nothing here loops over words in Python: a block of rows is handled as one byte
buffer.  Blocks are cut by bytes, so memory does not depend on how long the
texts of a batch are; one text larger than a block is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

# The white space of every word contract, U+0020 and U+0009-U+000D.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE_SPACE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# Words of more bytes are digested one by one.
_LONG_WORD = 4096
# The first n of eight bytes, for n from 0 to 8.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# Bases of the polynomial hashes of runs of words (odd, so they have inverses modulo 2**64).
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93, "other": 0xA0761D6478BD642F}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _powers_of(base: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        value = _BASES[base]
        tables = []
        for x in (value, pow(value, -1, 2**64)):
            table = np.full(size, x, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        have = _powers[base] = (tables[0], tables[1])
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = (np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size
            else np.zeros(0, np.uint8))
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[first, last)`` of a string column of about ``limit`` bytes each."""
    offsets = utf8_parts(column)[1]
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of a block of texts.

    ``data``/``offsets`` hold the words' bytes back to back, ``doc`` the row of
    each word and ``first`` each row's first word (one longer than the rows).
    """

    def __init__(self, column: pa.Array, lower: bool):
        raw, rows = utf8_parts(column)
        n = len(raw)
        if lower:
            raw = LOWER[raw]
        solid = ~_SPACE[raw]
        row_start = np.zeros(n + 1, bool)
        row_start[rows] = True
        before = np.ones(n, bool)         # white space or a row's start stands before
        after = np.ones(n, bool)          # white space or a row's end stands after
        if n:
            before[1:] = ~solid[:-1] | row_start[1:n]
            after[:-1] = ~solid[1:] | row_start[1:n]
        starts = np.flatnonzero(solid & before)
        ends = np.flatnonzero(solid & after) + 1
        self.n_docs = len(rows) - 1
        self.data = raw[solid]
        self.offsets = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=self.offsets[1:])
        self.doc = np.searchsorted(rows, starts, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs + 1), "left")
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.doc)

    def arrow(self) -> pa.Array:
        """The words as an Arrow string array (no copy of the bytes)."""
        return pa.LargeStringArray.from_buffers(
            len(self), pa.py_buffer(self.offsets),
            pa.py_buffer(np.ascontiguousarray(self.data)))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes.

        Eight bytes at a time are mixed into the hash so far, for all words that
        still have some; what is mixed twice is not linear in the bytes, unlike a
        polynomial modulo 2**64, for which unlike words with equal hashes are
        easily written.  Long words are digested one by one.
        """
        start, size = self.offsets[:-1], np.diff(self.offsets)
        out = mix(size.astype(np.uint64), 1)
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
        live, done = np.flatnonzero((size > 0) & (size <= _LONG_WORD)), 0
        while len(live):
            left = size[live] - done
            value = eight[start[live] + done].view("<u8").ravel() & _FIRST_BYTES[np.minimum(left, 8)]
            out[live] = mix(out[live] ^ mix(value, 2), 3)
            live, done = live[left > 8], done + 8
        for i in np.flatnonzero(size > _LONG_WORD).tolist():
            word = self.data[start[i]:start[i] + size[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


class Runs:
    """Hashes of runs of consecutive words, from one prefix sum over word hashes."""

    def __init__(self, hashes: np.ndarray, base: str = "word"):
        power, self.inverse = _powers_of(base, len(hashes) + 1)
        self.total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes, len(base)) * power[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words ``[start, end)``; runs of other lengths hash differently."""
        return mix((self.total[end] - self.total[start]) * self.inverse[start]
                   + (end - start).astype(np.uint64))


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word n-grams of every row: ``(row, hash)`` sorted by row, then hash.

    A row with fewer than ``size`` words but at least one has its whole
    sequence as its one n-gram; a row without words has none.
    """
    run = Runs(words.hashes())
    per_row = np.maximum(words.counts - size + 1, (words.counts > 0).astype(np.int64))
    row = np.repeat(np.arange(words.n_docs), per_row)
    begin = np.zeros(words.n_docs + 1, np.int64)
    np.cumsum(per_row, out=begin[1:])
    start = words.first[:-1][row] + np.arange(len(row)) - begin[:-1][row]
    end = start + np.minimum(size, words.counts[row])
    h = run.of(start, end)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        row, h = row[new], h[new]
    return row, h
