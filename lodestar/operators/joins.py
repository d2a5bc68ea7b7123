"""Join-side helpers.

``broadcast()`` is only applied to a side whose rows and bytes are measured to
be small.  Anything larger is left to a shuffle join, where adaptive query
execution can still switch to a broadcast at run time from measured sizes and
split skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.session import shuffles_freed

# Budgets of a checked broadcast: both must hold, since a row can be of any width.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20
_ROW_BYTES = 64


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: strings by their length, the rest by JSON or 8 each."""
    total = F.lit(_ROW_BYTES)
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = F.octet_length(c)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
            width = F.size(c) * 8
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width = F.octet_length(F.to_json(F.struct(c)))
        else:
            width = F.lit(8)
        total = total + F.coalesce(width, F.lit(0))
    return total.cast("long")


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of ``max_bytes`` together.

    One plain aggregate: two partial sums per partition reach the driver.
    (``limit(n).count()`` would move up to ``n`` rows of every partition
    through a single task before counting.)
    """
    with shuffles_freed(df.sparkSession):
        rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if it :func:`fits_broadcast`, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def vector_broadcast_rows(dims: int, budget_bytes: int = 256 << 20) -> int:
    """Row budget for broadcasting a table of ``dims``-long double vectors."""
    return max(1, budget_bytes // (8 * dims + 64))
