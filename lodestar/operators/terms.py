"""O3 — article text to distinct noun terms.

Long form throughout: ``(article_id, pos, term)`` with one row per distinct
term of an article, ``pos`` = its rank of first occurrence.  Term lists are
only collected back into one row per article at a sink
(:func:`terms_by_article`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.strings import HAN_PATTERN, split_terms, terms_to_string
from lodestar.operators.joins import bounded_broadcast

# Candidate lengths that are always made; longer ones come from the dictionary.
DEFAULT_HAN_NGRAMS = (2, 3, 4, 5, 6, 7, 8)


def tokenize(docs: DataFrame, id_col: str = "article_id", text_col: str = "content",
             min_len: int = 2, distinct: bool = True,
             han_ngrams: tuple[int, ...] | None = None) -> DataFrame:
    """``(article_id string, pos int, term string)``; NULL text and NULL ids are dropped.

    Pure per-row expressions plus ``posexplode``: no shuffle.
    """
    return (
        docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("string").alias("article_id"),
                F.posexplode(split_terms(F.col(text_col), min_len, han_ngrams, distinct))
                .alias("pos", "term"))
    )


def drop_stopwords(terms: DataFrame, stopwords: DataFrame, word_col: str = "word",
                   term_col: str = "term") -> DataFrame:
    """Left-anti join against a stop list (broadcast when its size checks out)."""
    # An anti join only tests existence: duplicate stop words need no distinct.
    stop = bounded_broadcast(stopwords.select(F.col(word_col).alias("_stop")))
    return terms.join(stop, terms[term_col] == stop["_stop"], "left_anti")


def keep_pos(terms: DataFrame, dictionary: DataFrame, prefix: str = "n",
             term_col: str = "term", word_col: str = "word", pos_col: str = "pos") -> DataFrame:
    """Keep terms whose dictionary part of speech starts with ``prefix``.

    A left-semi join: the dictionary only filters, it adds no columns.
    Words missing from the dictionary are dropped.
    """
    words = bounded_broadcast(dictionary.where(F.col(pos_col).startswith(prefix))
                              .select(F.col(word_col).alias("_word")))
    return terms.join(words, terms[term_col] == words["_word"], "left_semi")


def build_dictionary(lists: Sequence[tuple[DataFrame, str | None]], word_col: str = "word",
                     pos_col: str = "pos", freq_col: str = "freq") -> DataFrame:
    """R2: union of word lists -> ``(word, pos)``, one row per word.

    Each list is ``(frame, default_pos)``; a list's own ``pos`` column wins over
    its default when present and not NULL.  On duplicates the earlier list wins,
    also where it leaves the word untagged (``pos`` is NULL then); within one
    list a tagged entry wins, and the smallest tag, for determinism.  If any list
    has a ``freq`` column the result has one too: the winning list's highest
    frequency of the word (NULL if it gives none).
    Implemented as ``min`` over structs that begin with the priority, which
    aggregate partially on the map side, so a word repeated in every list is
    never gathered in one place.
    """
    parts = []
    counted = any(freq_col in frame.columns for frame, _ in lists)
    for priority, (frame, default_pos) in enumerate(lists):
        pos = (F.coalesce(F.col(pos_col), F.lit(default_pos)) if pos_col in frame.columns
               else F.lit(default_pos)).cast("string")
        freq = F.col(freq_col) if freq_col in frame.columns else F.lit(None)
        word = F.col(word_col).cast("string")
        parts.append(frame.where(word.isNotNull()).select(
            word.alias("word"), F.lit(priority).alias("_prio"), pos.isNull().alias("_untagged"),
            pos.alias("pos"), freq.cast("long").alias("freq")))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    best = union.groupBy("word").agg(
        F.min(F.struct("_prio", "_untagged", "pos")).alias("_best"),
        F.min(F.struct("_prio", F.col("freq").isNull().alias("_none"),
                       (-F.col("freq")).alias("less"))).alias("_most"))
    out = [F.col("word"), F.col("_best.pos").alias("pos")]
    return best.select(*out, (-F.col("_most.less")).alias("freq")) if counted else best.select(*out)


def han_lengths(dictionary: DataFrame, prefix: str = "n", word_col: str = "word",
                pos_col: str = "pos",
                always: tuple[int, ...] = DEFAULT_HAN_NGRAMS) -> tuple[int, ...]:
    """``always`` and every length that a Han word tagged ``prefix*`` has.

    One distributed distinct; only the lengths reach the driver.
    """
    word = F.col(word_col)
    found = (dictionary.where(F.col(pos_col).startswith(prefix)
                              & word.rlike("^" + HAN_PATTERN + "+$"))
             .select(F.length(word).alias("n")).distinct().collect())
    return tuple(sorted({*always, *(r["n"] for r in found)}))


def content_terms(docs: DataFrame, stopwords: DataFrame | None = None,
                  dictionary: DataFrame | None = None, min_len: int = 2, pos_prefix: str = "n",
                  id_col: str = "article_id", text_col: str = "content", distinct: bool = True,
                  han_ngrams: tuple[int, ...] | None = None, han: str = "ngrams") -> DataFrame:
    """O3: ``(article_id, pos, term)`` — distinct terms, no stop words, length >= ``min_len``.

    With a ``dictionary`` only terms tagged ``pos_prefix*`` are kept.  Unspaced
    Han runs are cut into words first: with ``han="lattice"`` along the one
    cheapest path through the dictionary's words and frequencies
    (:func:`lodestar.operators.segment.segmented_terms`); with ``han="ngrams"``
    every substring that is a dictionary word is a term: of 2–8 characters and
    of every longer length the dictionary has (:func:`han_lengths`), or of
    exactly ``han_ngrams`` if given.  Articles left with no term simply have no
    rows (F6).
    """
    if han not in ("ngrams", "lattice"):
        raise ValueError("han must be 'ngrams' or 'lattice'")
    if dictionary is not None and han == "lattice":
        from lodestar.operators.segment import segmented_terms

        terms = segmented_terms(docs, dictionary, id_col, text_col, min_len, distinct)
    else:
        ngrams = None
        if dictionary is not None:
            ngrams = han_lengths(dictionary, pos_prefix) if han_ngrams is None else han_ngrams
        terms = tokenize(docs, id_col, text_col, min_len, distinct, ngrams)
    if dictionary is None:
        return terms if stopwords is None else drop_stopwords(terms, stopwords)
    if stopwords is not None:
        # stop words leave the word list, which is short, so each term is looked up once
        dictionary = drop_stopwords(dictionary, stopwords, term_col="word")
    return keep_pos(terms, dictionary, pos_prefix)


def terms_by_article(terms: DataFrame, as_string: bool = False) -> DataFrame:
    """Long form -> ``(article_id, terms)`` in text order (the at-rest form).

    One group is one article, bounded by the length of its text.
    """
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))),
                          lambda s: s["term"])
    # dealt as single terms: a list that is made before the shuffle takes more than its terms
    out = terms.repartition("article_id").groupBy("article_id").agg(ordered.alias("terms"))
    if as_string:
        out = out.select("article_id", terms_to_string("terms").alias("content_terms"))
    return out


def terms_from_rest(table: DataFrame, terms_col: str = "content_terms",
                    sep: str = ",") -> DataFrame:
    """At-rest terms (a delimited string or an array per article) -> long form
    ``(article_id, pos, term)``; empty terms and NULL lists give no row."""
    terms = F.col(terms_col)
    if dict(table.dtypes)[terms_col] == "string":
        terms = F.split(terms, sep)
    return (table.select("article_id", F.posexplode(
                F.filter(terms, lambda t: F.length(t) > 0)).alias("pos", "term")))
