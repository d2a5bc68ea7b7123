"""Word-list files as tables (stop words, dictionaries).

A line is ``word [pos [freq [pos freq ...]]]``; the first part of speech is the
word's main one.  A missing list falls back to another path (the default list),
as a custom dictionary path that does not exist falls back to the bundled one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.terms import build_dictionary


def read_word_list(spark: SparkSession, path: str, default_pos: str | None = None,
                   fallback: str | None = None) -> DataFrame:
    """``(word, pos, freq)`` from a whitespace-separated word-list file; blank lines skipped.

    ``freq`` sums the frequencies of all the word's tags (NULL if the line has
    none that is a whole number).  Only a path that does not exist is read from
    ``fallback``; any other failure is the caller's.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if fallback is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.read.text(fallback)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    counts = F.filter(F.transform(F.filter(parts, lambda x, i: (i > 0) & (i % 2 == 0)),
                                  lambda x: x.try_cast("long")), lambda n: n.isNotNull())
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)
    return (lines.where(F.trim(F.col("value")) != "")
            .select(F.get(parts, 0).alias("word"),
                    F.coalesce(F.get(parts, 1), F.lit(default_pos)).alias("pos"),
                    F.when(F.size(counts) > 0, total).alias("freq")))


def read_dictionary(spark: SparkSession, lists: list[tuple[str, str | None]],
                    fallback: str | None = None) -> DataFrame:
    """R2 from files: ``[(path, default_pos), ...]`` in priority order ->
    ``(word, pos, freq)``.

    Each file's own tags win over its default; on duplicates the earlier file
    wins.  A missing file is read from ``fallback`` instead (when given).
    """
    frames = [(read_word_list(spark, path, None, fallback), default_pos)
              for path, default_pos in lists]
    return build_dictionary(frames)
