"""Packed training sequences: token id matrices, segment lengths, position resets.

Documents are tokenised, cut losslessly at ``max_tokens`` and packed best fit
decreasing (the plan of :mod:`lodestar.llm.packing`).  Every output row is one
row of the id matrix with its cumulative segment lengths (as variable-length
attention kernels take them) and the positions at which counting restarts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks, saved
from lodestar.llm.packing import MAX_TOKENS, place_pieces, token_pieces, unpacked_ids

PAD_ID = 0
ROW_TOKENS = 1 << 22            # of the id matrix, built at once


def _matrix(flat: np.ndarray, inside: np.ndarray, fill: int) -> pa.Array:
    """``flat`` row by row where ``inside``, ``fill`` elsewhere: the bytes of each row."""
    rows, width = inside.shape
    out = np.full((rows, width), fill, "<u4")
    out[inside] = flat
    ends = np.arange(rows + 1, dtype=np.int32) * np.int32(4 * width)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _lists(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(per_row)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def _rows(batches, max_tokens: int):
    at_once = max(1, ROW_TOKENS // max_tokens)
    for whole in batches:
        for first in range(0, whole.num_rows, at_once):
            batch = whole.slice(first, at_once)
            n = batch.num_rows
            parts, starts = (batch.column(i).flatten().to_numpy() for i in (1, 3))
            row = np.repeat(np.arange(n), batch.column(1).value_lengths().to_numpy())
            used = np.bincount(row, parts, n).astype(np.int64)
            end = np.cumsum(parts)                        # in all rows one after the other
            begin = end - parts
            base = (np.cumsum(used) - used)[row]
            ids = np.concatenate([unpacked_ids(x.as_buffer(), k) for x, k in
                                  zip(batch.column(2).flatten(), parts.tolist())])
            position = np.arange(len(ids)) - np.repeat(begin - starts, parts)
            inside = np.arange(max_tokens) < used[:, None]
            pieces = np.bincount(row, minlength=n)
            zero = np.cumsum(pieces) - pieces             # before each row's first end
            new = starts == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(used, pa.int32()), _matrix(ids, inside, PAD_ID),
                 _lists(np.insert(end - base, zero, 0), pieces + 1),
                 _lists((begin - base)[new], np.bincount(row[new], minlength=n)),
                 _matrix(position, inside, 0), batch.column(4), batch.column(5)],
                names=["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_resets",
                       "position_ids", "doc_ids", "pieces"])


def packed_sequences(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                     max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per sequence.

    ``sequence_id``, ``n_tokens`` (without padding), ``input_ids`` and
    ``position_ids`` (``max_tokens`` little-endian unsigned 32-bit numbers),
    ``cu_seqlens`` (0 and the end of each segment), ``position_resets`` (where a
    document begins; a piece that continues a cut document keeps counting),
    ``doc_ids`` and ``pieces`` of the segments in order.  A group is one
    sequence, so it holds at most ``max_tokens`` tokens.  A null or empty text is
    its end id; rows without an id are packed with a null in ``doc_ids``; an
    empty table gives no sequence.
    """
    pieces = saved(token_pieces(docs, path, text_col, id_col, max_tokens, with_ids=True))
    placed = place_pieces(pieces, max_tokens)
    packed = F.array_sort(F.collect_list(F.struct("offset", "length", "start", "doc_id", "piece",
                                                  "ids")))
    rows = placed.groupBy("sequence_id").agg(packed.alias("p")).select(
        "sequence_id", F.transform("p", lambda x: x["length"]).alias("lengths"),
        F.transform("p", lambda x: x["ids"]).alias("ids"),
        F.transform("p", lambda x: x["start"]).alias("starts"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("p", lambda x: x["piece"]).alias("pieces"))
    return rows.transform(in_tasks, 
        lambda it: _rows(it, max_tokens),
        "sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, "
        "position_resets array<int>, position_ids binary, doc_ids array<long>, pieces array<int>")


def write_matrices(sequences: DataFrame, folder: str) -> None:
    """Write the sequences as Parquet, one id-matrix row per record, ordered in each file."""
    (sequences.sortWithinPartitions("sequence_id")
     .write.mode("overwrite").parquet(folder))
