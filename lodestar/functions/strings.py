"""String columns: phone tail, e-mail domain, term lists.

All built from JVM-side expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokeniser splits on every run of characters that are
# neither letters nor digits (any script), after lower-casing.
TOKEN_SPLIT_PATTERN = r"[^\p{L}\p{N}]+"
# A token holding a Han character is an unspaced run of Chinese
# text; it is expanded into candidate words of several lengths.
HAN_PATTERN = r"\p{IsHan}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def phone_tail(mobile: Column | str, n: int = 11) -> Column:
    """Last ``n`` characters of a phone number (drops a country prefix).

    Shorter numbers, empty strings and NULL give ``''``.
    ``8615686823255`` -> ``15686823255``.
    """
    m = _col(mobile)
    return F.when(F.length(m) >= n, F.substring(m, -n, n)).otherwise(F.lit(""))


def email_domain(email: Column | str) -> Column:
    """Part after ``@`` when the address splits into exactly two parts, else ``''``.

    ``a@b.com`` -> ``b.com``; ``a@`` -> ``''``; ``@b`` -> ``b``;
    ``a@b@c``, ``noat`` and NULL -> ``''``.
    """
    parts = F.split(_col(email), "@")
    # The size guard keeps the index in range under ANSI mode; get() is NULL-safe.
    return F.when(F.size(parts) == 2, F.get(parts, 1)).otherwise(F.lit(""))


def _grams_of_length(token: Column, n: int) -> Column:
    """Substrings of exactly ``n`` characters as ``struct(o, n, w)``, by offset.

    Built in a helper (not a lambda with a default argument): ``transform`` and
    ``filter`` treat a two-parameter lambda as ``(element, index)``.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.length(token) - n, F.lit(0)))
    grams = F.transform(starts, lambda i: F.struct(i.alias("o"), F.lit(n).alias("n"),
                                                   F.substring(token, i + 1, n).alias("w")))
    return F.filter(grams, lambda s: F.length(s["w"]) == n)


def _han_ngrams(token: Column, lengths: tuple[int, ...]) -> Column:
    """All substrings of ``token`` whose length is in ``lengths``, in text order."""
    grams = [_grams_of_length(token, n) for n in lengths]
    # Order candidate words by start offset, then by length, so the first
    # occurrence in the text comes first after array_distinct.
    merged = F.array_sort(F.concat(*grams)) if len(grams) > 1 else grams[0]
    return F.transform(merged, lambda s: s["w"])


def split_terms(text: Column | str, min_len: int = 2,
                han_ngrams: tuple[int, ...] | None = None,
                distinct: bool = True) -> Column:
    """Text -> array of lower-case terms in text order.

    Splits on non-letter/non-digit runs, drops terms shorter than ``min_len``
    characters and, with ``distinct``, keeps only the first occurrence of each
    term.  With ``han_ngrams`` (e.g. ``(2, 3, 4)``) every run of Han characters
    is replaced by its candidate words of those lengths; a dictionary
    join is expected to keep the real ones.  This approximates a statistical
    Chinese segmenter; it is not equal to one.
    """
    tokens = F.split(F.lower(_col(text)), TOKEN_SPLIT_PATTERN)
    if han_ngrams:
        lengths = tuple(sorted({n for n in han_ngrams if n >= 1}))
        # a Han run is a token of its own, letters and digits beside it another
        apart = F.regexp_replace(F.lower(_col(text)), "(" + HAN_PATTERN + "+)", " $1 ")
        expanded = F.flatten(F.transform(
            F.split(apart, TOKEN_SPLIT_PATTERN),
            lambda t: F.when(t.rlike(HAN_PATTERN), _han_ngrams(t, lengths))
            .otherwise(F.array(t)),
        ))
        # Texts without any Han character skip the per-token lambda entirely; those of
        # single bytes have none and are not searched.
        wide = F.octet_length(_col(text)) > F.length(_col(text))
        tokens = F.when(wide & _col(text).rlike(HAN_PATTERN), expanded).otherwise(tokens)
    kept = F.filter(tokens, lambda t: F.length(t) >= min_len)
    return F.array_distinct(kept) if distinct else kept


def terms_to_string(terms: Column | str, sep: str = ",") -> Column:
    """Array of terms -> one delimited string (the at-rest form of a term list)."""
    return F.array_join(_col(terms), sep)
