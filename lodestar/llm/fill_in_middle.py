"""Fill-in-the-middle transformation of whole documents.

Every text is cut into units (its lines), two of whose bounds part it into a
prefix, a middle and a suffix; the three are written in the order in which a
model is trained to fill the middle.  A batch of texts is one pipeline of
``pyarrow.compute`` calls: units are split into lists, flattened with the index
of their parent row, numbered, filtered by role, rebuilt into lists and joined.
No step loops over rows, and nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks
from lodestar.llm._text import row_blocks

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50

_SCHEMA = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
           "output string")


def _modulo(a, b):
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def units(text: pa.Array) -> pa.ListArray:
    """The lines of every text, each with its line break; an empty text has none."""
    text = text.cast(pa.large_string())
    parts = pc.split_pattern(text, "\n")
    flat, row = pc.list_flatten(parts), pc.list_parent_indices(parts).cast(pa.int64())
    last = _ordinals(row, pc.list_value_length(parts), from_end=True)
    is_last = pc.equal(last, 0)
    whole = pc.if_else(is_last, flat, pc.binary_join_element_wise(
        flat, pa.scalar("\n", flat.type), pa.scalar("", flat.type)))
    keep = pc.invert(pc.and_(is_last, pc.equal(flat, "")))
    return _rebuilt(whole.filter(keep), row.filter(keep), len(text))


def _ordinals(row: pa.Array, sizes: pa.Array, from_end: bool = False) -> pa.Array:
    """The number of each flattened value within its parent, from 0."""
    ends = pc.cumulative_sum(sizes.cast(pa.int64()))
    at = pa.array(np.arange(len(row)))
    if from_end:
        return pc.subtract(pc.subtract(ends.take(row), 1), at)
    return pc.subtract(at, pc.subtract(ends, sizes.cast(pa.int64())).take(row))


def _rebuilt(values: pa.Array, row: pa.Array, rows: int) -> pa.ListArray:
    """Flattened values and their parents as one list for each of ``rows`` parents."""
    offsets = np.searchsorted(row.to_numpy(), np.arange(rows + 1))
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values)


def _concatenated(values: pa.Array, row: pa.Array, chosen: pa.Array, rows: int) -> pa.Array:
    """The chosen units of every row joined to one text."""
    lists = _rebuilt(values.filter(chosen), row.filter(chosen), rows)
    return pc.binary_join(lists, pa.scalar("", values.type))


def transform(text: pa.Array, draws: list[pa.Array], fim_percent: int,
              spm_percent: int) -> list[pa.Array]:
    """``n, form, prefix_chars, middle_chars, output`` of a block of texts; ``draws``
    are four arrays of whole numbers >= 0."""
    rows = len(text)
    text = text.cast(pa.large_string())
    lists = units(text)
    sizes = pc.list_value_length(lists).cast(pa.int64())
    cuts = [_modulo(d, pc.add(sizes, 1)) for d in draws[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
    ordinal = _ordinals(row, sizes)
    in_prefix = pc.less(ordinal, low.take(row))
    in_suffix = pc.greater_equal(ordinal, high.take(row))
    prefix = _concatenated(flat, row, in_prefix, rows)
    middle = _concatenated(flat, row, pc.invert(pc.or_(in_prefix, in_suffix)), rows)
    suffix = _concatenated(flat, row, in_suffix, rows)
    plain = pc.equal(pc.binary_length(text), 0)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(text, mark))
    plain = pc.or_(plain, pc.greater_equal(_modulo(draws[2], pa.scalar(100)), fim_percent))
    spm = pc.less(_modulo(draws[3], pa.scalar(100)), spm_percent)
    p, s, m, none = (pa.scalar(x, text.type) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    output = pc.if_else(plain, text, pc.if_else(
        spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, none),
        pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, none)))
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    missing = pa.nulls(rows, pa.int64())
    return [sizes, form,
            pc.if_else(plain, missing, pc.utf8_length(prefix).cast(pa.int64())),
            pc.if_else(plain, missing, pc.utf8_length(middle).cast(pa.int64())), output]


def restored(form: pa.Array, output: pa.Array) -> pa.Array:
    """The original texts, from the outputs and their forms alone."""
    output = output.cast(pa.large_string())
    plain, spm = pc.equal(form, "plain"), pc.equal(form, "spm")
    # every mark occurs once in an output that is not plain, so one cut finds it
    safe = pc.if_else(plain, pa.scalar(PREFIX + SUFFIX + MIDDLE, output.type), output)
    head, middle = _halves(safe, MIDDLE)
    before_s, after_s = _halves(head, SUFFIX)         # psm: <P>prefix | suffix
    _, after_p = _halves(head, PREFIX)                # spm: <S>suffix | prefix
    none = pa.scalar("", output.type)
    psm_prefix = pc.utf8_slice_codeunits(before_s, len(PREFIX))
    spm_suffix = pc.utf8_slice_codeunits(_halves(head, PREFIX)[0], len(SUFFIX))
    text = pc.binary_join_element_wise(pc.if_else(spm, after_p, psm_prefix), middle,
                                       pc.if_else(spm, spm_suffix, after_s), none)
    return pc.if_else(plain, output, text)


def _halves(text: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first ``mark`` (each text holds it)."""
    parts = pc.split_pattern(text, mark, max_splits=1)
    return pc.list_element(parts, 0), pc.list_element(parts, 1)


def _small(columns: list[pa.Array]) -> list[pa.Array]:
    return [c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in columns]


def _transformed(batches, fim_percent: int, spm_percent: int):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    for batch in batches:
        text = batch.column(1)
        for first, last in row_blocks(text):
            part = batch.slice(first, last - first)
            out = transform(part.column(1), [part.column(2 + k) for k in range(4)],
                            fim_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([part.column(0), *_small(out)], names=names)


def fill_in_middle(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                   seed: int = SEED) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per document.

    ``n`` is the number of lines.  The draws of a document are the first four
    8-digit groups of the sha256 of ``seed:doc_id``, so its result depends on
    nothing else: two bounds, whether it is transformed at all (``fim_percent``
    of a hundred) and in which order (``spm_percent`` of a hundred: suffix
    first).  ``form`` is ``psm``, ``spm`` or ``plain``; a plain output is the
    text itself and its ``prefix_chars`` and ``middle_chars`` are null.  Empty
    and null texts and texts that hold a mark are plain.  A null id draws as an
    empty one; repeated rows give repeated results; an empty table an empty
    one.  Texts of any length are handled whole, about a megabyte of rows at a
    time.  Other columns play no part.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"),
                             F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}")
             for k in range(4)]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *draws)
    return in_tasks(rows, lambda it: _transformed(it, fim_percent, spm_percent), _SCHEMA)


def restore(transformed: DataFrame) -> DataFrame:
    """``transformed`` with a column ``restored``: the text rebuilt from ``output`` and
    ``form`` alone.  A column of that name is replaced."""
    kept = [c for c in transformed.columns if c != "restored"]
    schema = ", ".join(f"`{n}` {t}" for n, t in transformed.select(kept).dtypes)

    def run(batches):
        for batch in batches:
            output = batch.column("output")
            for first, last in row_blocks(output):
                part = batch.slice(first, last - first)
                text = restored(part.column("form"), part.column("output"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, text.cast(pa.string())], names=[*kept, "restored"])

    return in_tasks(transformed.select(kept), run, f"{schema}, restored string")
