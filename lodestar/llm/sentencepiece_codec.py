"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is written as the vocabulary does: a space in front, every space as
U+2581.  No piece runs past the end of a word into the next space or over a line
feed, so the best segmentation of a text is those of its words (a run of spaces
and what follows).  A block of texts is cut into words as one byte buffer, and each
distinct word is segmented once and remembered.
Nothing is normalised away: decoding gives the text back, byte for byte.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks
from lodestar.llm._text import row_blocks, utf8_parts
from lodestar.llm.lattice import SPACE, Pieces, best_paths, load_vocabulary

CACHE_WORDS = 400_000
BLOCK_BYTES = 4 << 20


class Codec:
    """Encoder and decoder of one vocabulary, kept by a Python worker from task to task.

    At most ``cache_words`` words are kept between blocks; when they are too many, the
    less used half goes.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        self.pieces, self.names = load_vocabulary(path)
        self.cache_words = cache_words
        byte_of = {int(i): b for b, i in enumerate(self.pieces.byte_ids)}
        self.text_of = [bytes([byte_of[i]]) if i in byte_of
                        else n.encode() for i, n in enumerate(self.names)]
        self.known: dict[str, int] = {}      # words in the order of ``starts``
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.uses = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the more used half of ``cache_words``, in order of use."""
        keep = np.argsort(-self.uses, kind="stable")[:self.cache_words // 2]
        names = list(self.known)
        size = np.diff(self.starts)[keep]
        ids = self.ids[_spread(self.starts[keep], size)]
        self.starts, self.ids = np.append(0, np.cumsum(size)), ids
        self.known = {names[k]: i for i, k in enumerate(keep.tolist())}
        self.uses = self.uses[keep] // 2

    def _learn(self, words: list[str]) -> None:
        ids, size = best_paths(self.pieces, [w.replace(" ", SPACE) for w in words])
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(size))
        self.ids = np.append(self.ids, ids)
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows back to back, and the rows' bounds."""
        data, cuts, first = _words(column)
        coded = pa.LargeStringArray.from_buffers(
            len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        unique = coded.dictionary.to_pylist()
        index = coded.indices.to_numpy(zero_copy_only=False)
        at = np.fromiter(map(self.known.get, unique, repeat(-1)), np.int64, len(unique))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([unique[i] for i in new.tolist()])
        self.uses[at] += np.bincount(index, minlength=len(at))
        size = (self.starts[at + 1] - self.starts[at])[index]
        ids = self.ids[_spread(self.starts[at][index], size)]
        bounds = np.append(0, np.cumsum(size))[first]
        if len(self.known) > self.cache_words:
            self._forget()
        return ids, bounds

    def decode(self, ids) -> str:
        """The text of a sequence of ids (of this encoder)."""
        raw = b"".join(map(self.text_of.__getitem__, np.asarray(ids).tolist()))
        text = raw.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``start[i] .. start[i] + size[i] - 1`` for all i, back to back."""
    begin = np.cumsum(size) - size
    return np.repeat(start - begin, size) + np.arange(size.sum())


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the rows with a space in front, where their words begin (and the last
    ends), and each row's first word.

    A word is a run of spaces with what follows, or a line feed, which no piece
    contains.  U+2581 counts as a space, an empty row has no word.
    """
    text = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), SPACE, " ")
    text = pc.if_else(pc.equal(text, ""), text, pc.binary_join_element_wise(
        pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
    data, offsets = utf8_parts(text)
    space, feed = data == 0x20, data == 0x0A
    begins = feed | space
    begins[1:] &= feed[1:] | ~space[:-1]
    begins[1:] |= feed[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    cuts = np.append(np.flatnonzero(begins), len(data)).astype(np.int64)
    return data, cuts, np.searchsorted(cuts, offsets)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode(batches, path: str):
    coder = codec(path)
    for batch in batches:
        column = batch.column(1)
        for first, last in row_blocks(column, BLOCK_BYTES):
            ids, bounds = coder.encode(column.slice(first, last - first))
            raw = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), last - first,
                [None, pa.py_buffer((bounds * 4).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), raw.cast(pa.binary())],
                names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, text_col: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, ids)``: little-endian unsigned 32-bit piece ids of every whole text.

    A null or empty text has no ids.  A text that contains U+2581 decodes with
    spaces in its place, as with the original; all others decode exactly.
    Repeated rows, null ids and other columns have no influence on a row.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.transform(in_tasks, lambda it: _encode(it, path), "doc_id long, ids binary")


def _decode(batches, path: str):
    coder = codec(path)
    for batch in batches:
        texts = [coder.decode(np.frombuffer(x.as_buffer(), "<u4")) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                         names=["doc_id", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, text)`` of the rows of :func:`encode`."""
    rows = encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids"))
    return rows.transform(in_tasks, lambda it: _decode(it, path), "doc_id long, text string")


def _digest(batches, path: str):
    coder = codec(path)
    for batch in batches:
        n, crc, sha = [], [], []
        for x in batch.column(1):
            raw = x.as_buffer()
            ids = np.frombuffer(raw, "<u4")
            n.append(len(ids))
            crc.append(zlib.crc32(raw))
            sha.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha)],
            names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256"])


def encode_digests(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_pieces, ids_crc32, decoded_sha256)`` of the rows of :func:`encode`."""
    return encoded.transform(in_tasks, 
        lambda it: _digest(it, path),
        "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string")
