"""Secrets in texts, found through a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over the
trigrams that any match must contain.  The index holds, for each of these
trigrams, the texts that contain it; a rule's candidates come from intersecting
and uniting its postings, and only candidates are verified with the regular
expression.  A rule without a mandatory trigram scans every text.  All of it
is DataFrame operations.

The index and the queries ignore case, so they can only let too many through.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in their order, as the contract states them.
# A run of hexadecimal digits below 24 is no match either way; the look-behind
# only keeps the scan from trying every place in it again.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
# A PEM key: from its header to the next END line, whatever stands between
# (quotes, line prefixes) but another run of five hyphens.  Without an END line,
# its header fields and the base64 that follows: lines of nothing else, and runs
# of 20 characters or with padding anywhere.  Line breaks may be escaped.  All
# repeats of groups are possessive: no key is too long for the stack.
_BREAK = r"(?:[\r\n]|\\[rn])"
_APART = r"""(?:\\[rnt]|[\s"'`+,;>#*|\\])"""
_BASE64 = r"[A-Za-z0-9+/]"
_KEY_END = r"(?:[^-]++|-(?!----))*+-{5,}END [A-Z ]{0,20}PRIVATE KEY-----"
_KEY_BODY = (rf"(?:{_APART}*+(?:(?:Proc-Type|DEK-Info):\x20*+[^\s\\]++"
             rf"|(?:Comment|X(?:-[A-Za-z0-9]++)++):\x20[^\r\n\\]*+{_BREAK}))*+"
             rf"(?:{_APART}*+{_BASE64}{{20,}}+=*+"
             rf"|{_APART}*+{_BASE64}++=++"
             rf"|{_BREAK}{{1,2}}+[\x20\t>#*]*+{_BASE64}++(?=[\x20\t]*+(?:{_BREAK}|\Z)))*+")
# Formats of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
                        rf"(?:{_KEY_END}|{_KEY_BODY})"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES
MASK = "[SECRET]"
_MOST_STRINGS = 64
_MOST_TRIGRAMS = 4
FOLDED = 128            # matches of one text that are folded at once
MASKED = 512            # spans of one text that are masked at once
SPANS = "array<struct<start:int,kind:int,end:int>>"

# A query is None (any text may match) or a set of alternatives, each the set
# of trigrams that must all occur.
Query = frozenset[frozenset[str]] | None


def _any_of(strings: set[str]) -> Query:
    """The query for a text that contains one of ``strings``."""
    if any(len(s) < 3 for s in strings):
        return None
    return _least({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings})


def _least(alternatives) -> Query:
    """Without alternatives that another one implies."""
    return frozenset(a for a in alternatives if not any(b < a for b in alternatives))


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _least({x | y for x in a for y in b})


def _either(queries: list[Query]) -> Query:
    if any(q is None for q in queries):
        return None
    return _least({x for q in queries for x in q})


def _sequence(items) -> tuple[set[str] | None, Query]:
    """The strings that a sequence can match, if few, and its query."""
    known: set[str] = {""}
    query: Query = None
    exact = True
    for item in items:
        strings, needs = _node(item)
        query = _both(query, needs)
        if strings is not None and len(known) * len(strings) <= _MOST_STRINGS:
            known = {a + b for a in known for b in strings}
        else:
            query = _both(query, _any_of(known))
            known, exact = strings or {""}, False
    if exact:
        return known, query
    return None, _both(query, _any_of(known))


def _node(item) -> tuple[set[str] | None, Query]:
    op, value = item
    if op is K.LITERAL:
        return {chr(value).lower()}, None
    if op is K.IN:
        found: set[str] = set()
        for kind, v in value:
            if kind is K.LITERAL:
                found.add(chr(v).lower())
            elif kind is K.RANGE and v[1] - v[0] < 8:
                found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, None
        return (found, None) if len(found) <= 8 else (None, None)
    if op is K.SUBPATTERN:
        return _sequence(value[3])
    if op is K.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*[s for s, _ in parts]), None
        return None, _either([q if s is None else _both(q, _any_of(s)) for s, q in parts])
    if op in (K.MAX_REPEAT, K.MIN_REPEAT):
        low, high, inner = value
        strings, needs = _sequence(inner)
        if low == 0:
            return (strings | {""}, None) if high == 1 and strings is not None else (None, None)
        if low == high == 1:
            return strings, needs
        return None, needs if strings is None else _both(needs, _any_of(strings))
    if op in (K.ASSERT, K.ASSERT_NOT, K.AT):
        return {""}, None
    return None, None


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression, in lower case.

    Alternatives of trigrams that must all occur in any text with a match, or
    None if the expression demands none.
    """
    strings, query = _sequence(_parser.parse(pattern))
    query = query if strings is None else _both(query, _any_of(strings))
    if query is None:
        return None
    # a few of the trigrams of an alternative demand less than all, so no match is lost
    return _least({frozenset(sorted(a)[::-(-len(a) // _MOST_TRIGRAMS)]) for a in query})


def _postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """``(trigram, key)``: which texts contain each trigram."""
    low = rows.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.col("low").contains(t), F.lit(t))
                                     for t in trigrams]))
    return low.select("key", held.alias("held")).select(
        F.explode("held").alias("trigram"), "key")


def _candidates(rows: DataFrame, queries: list[Query]) -> DataFrame:
    """``(key, rules)``: the numbers of the rules whose query each text meets.

    The postings of an alternative's trigrams are intersected by collecting one bit
    for each of them, alternatives are united per rule.  Texts that meet none
    are missing.
    """
    wanted = [{"trigram": t, "rule": rule, "alternative": number, "bit": 1 << bit,
               "whole": (1 << len(every)) - 1}
              for rule, query in enumerate(queries) if query is not None
              for number, every in enumerate(sorted(query, key=sorted))
              for bit, t in enumerate(sorted(every))]
    # one row for each trigram of each alternative: the rules' own size
    needs = rows.sparkSession.range(1).select(F.inline(F.from_json(
        F.lit(json.dumps(wanted)),
        "array<struct<trigram:string,rule:int,alternative:int,bit:int,whole:int>>")))
    postings = _postings(rows, sorted({w["trigram"] for w in wanted}))
    return (postings.join(F.broadcast(needs), "trigram")
            .groupBy("key", "rule", "alternative", "whole").agg(F.bit_or("bit").alias("bits"))
            .where("bits = whole").groupBy("key").agg(F.collect_set("rule").alias("rules")))


def _chunks(items: Column, size: int) -> Column:
    """The numbers 0.. of the chunks of an array that is not empty."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int"))


def _chunk(items: Column, number: Column, size: int) -> Column:
    return F.slice(items, number * size + 1, F.lit(size))


def _lengths(rule: Rule, found: Column) -> Column:
    """Of every match ``found`` in order: the characters up to its end from the end
    of the match before it, its own, and those that the rule counts."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    between = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    one = F.arrays_zip(between.alias("gap"), found.alias("found"), value.alias("value"))
    return F.when(F.size(found) > 0, F.transform(one, lambda x: F.struct(
        (F.length(x["gap"]) + F.length(x["found"])).alias("step"),
        F.length(x["found"]).alias("size"), F.length(x["value"]).alias("counted"))))


def _spans(rule: Rule, number: int, items: Column) -> Column:
    """Spans of one rule: array of ``(start, kind, end)`` in code points.

    Places are running sums of lengths: inside chunks, then over the chunks, so
    no array as long as the matches is copied for each of them.
    """
    nothing = F.array().cast(SPANS)
    zero = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))

    def step(acc, x):
        end = acc["at"] + x["step"]
        span = F.struct((end - x["size"]).alias("start"), F.lit(number).alias("kind"),
                        end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            x["counted"] >= rule.least, F.concat(acc["spans"], F.array(span))
        ).otherwise(acc["spans"]).alias("spans"))

    parts = F.transform(_chunks(items, FOLDED), lambda c: F.aggregate(_chunk(items, c, FOLDED), zero, step))
    before = F.aggregate(parts, F.array(F.lit(0)), lambda acc, p: F.concat(
        acc, F.array(F.element_at(acc, -1) + p["at"])))
    # ``before`` has one entry more than there are parts
    moved = F.zip_with(F.slice(before, F.lit(1), F.size(_chunks(items, FOLDED))), parts,
                       lambda add, p: F.transform(p["spans"], lambda s: F.struct(
                           (s["start"] + add).alias("start"), s["kind"].alias("kind"),
                           (s["end"] + add).alias("end"))))
    return F.when(F.size(items) > 0, F.flatten(moved)).otherwise(nothing)


def _scanned(docs: DataFrame, text_col: str, id_col: str, rules: tuple[Rule, ...]) -> DataFrame:
    """``(row, text, spans)``: every row whole, so that no name of it can clash."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # a key that two different rows share could only add candidates
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       text.alias("text"),
                       F.xxhash64(F.col(f"`{id_col}`"), text).alias("key"))
    queries = [trigram_query(r.pattern) for r in rules]
    if any(q is not None for q in queries):
        rows = rows.join(_candidates(rows.select("key", "text"), queries), "key", "left")
    matches = [F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)) for r in rules]
    # three steps, each used more than once by the next: every expression runs once a text
    found = rows.select("row", "text", *[
        (m if q is None else F.when(F.array_contains("rules", i), m)).alias(f"found_{i}")
        for i, (q, m) in enumerate(zip(queries, matches))])
    items = found.select("row", "text", *[
        _lengths(r, F.col(f"found_{i}")).alias(f"items_{i}") for i, r in enumerate(rules)])
    every = F.array_sort(F.concat(*[
        _spans(r, i, F.col(f"items_{i}")) for i, r in enumerate(rules)]))
    return items.select("row", "text", every.alias("spans"))


def scan(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
         rules: tuple[Rule, ...] = RULES, names: tuple[str, str] = ("text", "spans")) -> DataFrame:
    """``docs`` with ``spans``, an array of ``(start, kind, end)`` in order.

    Places are code points, the end exclusive; ``kind`` is the rule's number in
    ``rules``.  Matches of one rule do not overlap; those of different rules
    may.  A null text is empty and has no span.  Repeated rows give repeated
    rows.  All columns of ``docs`` stay (one named like the added column is
    replaced).
    """
    found = _scanned(docs, text_col, id_col, rules)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c != names[1]],
                        F.col("spans").alias(names[1]))


def span_list(spans: Column, rules: tuple[Rule, ...] = RULES, kinds: int | None = None) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas; only the first ``kinds`` rules'."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"] < kinds)
    name = F.array(*[F.lit(r.name) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
           rules: tuple[Rule, ...] = RULES, length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by ``[SECRET]``; no row is dropped.

    Overlapping spans are replaced together.  ``length_col``, if the table has
    it, is set to the new length where a text changed.
    """
    found = _scanned(docs, text_col, id_col, rules)
    spans, text = F.col("spans"), F.col("text")
    # how far spans reach before each chunk of them, and after the last
    reach = F.aggregate(
        F.transform(_chunks(spans, MASKED), lambda c: F.array_max(
            F.transform(_chunk(spans, c, MASKED), lambda s: s["end"]))),
        F.array(F.lit(0)),
        lambda acc, e: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), e))))
    found = found.select("row", "text", "spans",
                         F.when(F.size(spans) > 0, reach).alias("reach"))
    reach = F.col("reach")

    def cut(c, x):
        """A chunk's spans and its part of the text, which later steps need not walk again."""
        return F.struct(
            _chunk(spans, c, MASKED).alias("spans"), x.alias("at"),
            F.substring(text, x + 1, F.element_at(reach, c + 2) - x).alias("part"))

    def mask(chunk):
        def step(acc, s):
            apart = s["start"] >= acc["at"]
            gap = F.substring(chunk["part"], acc["at"] - chunk["at"] + 1, s["start"] - acc["at"])
            return F.struct(
                F.greatest(acc["at"], s["end"]).alias("at"),
                F.when(apart, F.concat(acc["out"], gap, F.lit(MASK)))
                .otherwise(acc["out"]).alias("out"))

        start = F.struct(chunk["at"].alias("at"), F.lit("").alias("out"))
        return F.aggregate(chunk["spans"], start, step, lambda acc: acc["out"])

    chunks = F.zip_with(_chunks(spans, MASKED), F.slice(reach, F.lit(1), F.size(reach) - 1), cut)
    tail = F.substring(text, F.element_at(reach, -1) + 1, F.length(text))
    has = F.size(spans) > 0
    clean = F.concat(F.array_join(F.transform(chunks, mask), ""), tail)
    out = found.select("row", has.alias("has"), F.when(has, clean).alias("clean"))
    columns = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == text_col:
            columns.append(F.when(F.col("has"), F.col("clean"))
                           .otherwise(old).alias(c))
        elif c == length_col:
            kind = docs.schema[c].dataType
            columns.append(F.when(F.col("has"), F.length("clean").cast(kind))
                           .otherwise(old).alias(c))
        else:
            columns.append(old.alias(c))
    return out.select(*columns)
