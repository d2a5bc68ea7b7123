"""M1 — one segmentation of unspaced (Han) text by a dictionary with word frequencies.

Every run of Han characters is a word lattice: its edges are the dictionary
words found in it, at the cost ``-ln`` of their relative frequency, and single
characters that are no word, at a cost above the rarest word's.  The words of
the run are those of its cheapest path, so no two words overlap and a word
counts only where it is meant.

A dictionary whose measured size allows it is sent to the tasks, and each run is
read there where it stands (:mod:`lodestar.operators.word_paths`): no candidate becomes a row.  With a
larger one the lattice is made by Spark joins: candidate substrings of the lengths
that dictionary words have are joined to the dictionary.  A run falls apart
wherever no word crosses (a window over its edges), so the dynamic programming,
written as column expressions, works on short stretches and never leaves the JVM.
Costs are whole numbers: sums are exact and ties are real (the longer last word
wins), so both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.strings import HAN_PATTERN, TOKEN_SPLIT_PATTERN
from lodestar.operators.joins import bounded_broadcast, fits_broadcast
from lodestar.operators.word_paths import Words, code_points
from lodestar.session import ship_package

# Millionths of a natural logarithm in a unit of cost.
COST_UNITS = 1_000_000
# Budgets of a dictionary that every Python worker holds (its words and their prefixes).
TASK_WORDS = 500_000
TASK_BYTES = 64 << 20
# Characters of runs that a task reads together, up to one run more.
CHARS_AT_ONCE = 1 << 19


def _is_han() -> Column:
    return F.col("token").rlike("^" + HAN_PATTERN + "+$")


def word_costs(dictionary: DataFrame, word_col: str = "word",
               freq_col: str = "freq") -> DataFrame:
    """``(word, cost long)`` of the Han words: ``-ln((freq + 1) / (total + words))``.

    A dictionary without a ``freq`` column, or a NULL in it, counts as freq 0;
    a word listed more than once counts once, with its highest frequency.
    """
    freq = (F.coalesce(F.col(freq_col).cast("long"), F.lit(0).cast("long"))
            if freq_col in dictionary.columns else F.lit(0).cast("long"))
    words = (dictionary.where(F.col(word_col).rlike("^" + HAN_PATTERN + "+$"))
             .groupBy(F.col(word_col).alias("word")).agg(F.max(freq).alias("freq")))
    total = words.select(F.sum("freq") + F.count(F.lit(1))).scalar()
    return words.select("word", _cost(F.col("freq"), total).alias("cost"))


def _cost(freq: Column, total: Column) -> Column:
    return F.round(-F.log((freq + 1.0) / total) * COST_UNITS).cast("long")


def _shape(costs: DataFrame) -> tuple[list[int], int]:
    """The lengths that words have, and the cost of a character that is no word: just
    above the dearest word's.  One row for each length reaches the driver."""
    found = costs.groupBy(F.length("word").alias("n")).agg(F.max("cost").alias("cost")).collect()
    return sorted(r["n"] for r in found), 1 + max((r["cost"] for r in found), default=0)


def text_tokens(docs: DataFrame, id_col: str = "article_id",
                text_col: str = "content") -> DataFrame:
    """``(article_id, tok_no, token)``: lower-case tokens in text order, with Han runs
    apart from letters and digits beside them; NULL ids and texts are dropped."""
    apart = F.regexp_replace(F.lower(F.col(text_col)), "(" + HAN_PATTERN + "+)", " $1 ")
    return (docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("string").alias("article_id"),
                    F.posexplode(F.split(apart, TOKEN_SPLIT_PATTERN)).alias("tok_no", "token"))
            .where(F.length("token") > 0))


def lattice_edges(runs: DataFrame, costs: DataFrame, lengths: list[int]) -> DataFrame:
    """``(article_id, tok_no, start, stop, n, cost, word)``: the words of every run."""
    # the characters as an array: a candidate is a slice, wherever in a long run it is
    letters = runs.select("article_id", "tok_no", F.split("token", "").alias("letters"))
    grams = F.flatten(F.array(*[_grams(F.col("letters"), n) for n in lengths or [1]]))
    found = letters.select("article_id", "tok_no", F.explode(grams).alias("g")).select(
        "article_id", "tok_no", "g.start", (F.col("g.start") + F.col("g.n")).alias("stop"),
        "g.n", "g.word")
    return found.join(bounded_broadcast(costs), "word").select(
        "article_id", "tok_no", "start", "stop", "n", "cost", "word")


def _grams(letters: Column, n: int) -> Column:
    """All ``struct(start, n, word)`` of ``n`` characters; none if there are fewer."""
    last = F.size(letters) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        i.alias("start"), F.lit(n).alias("n"),
        F.array_join(F.slice(letters, i + 1, n), "").alias("word")))


def stretches(edges: DataFrame) -> DataFrame:
    """``(article_id, tok_no, start, stop, widest, ends)``: parts of a run that words
    chain together, with the words that end at each place of it (in order).  No
    word crosses from one part to the next; parts of single characters are left
    out."""
    run = Window.partitionBy("article_id", "tok_no").orderBy("start", "stop")
    reached = F.max("stop").over(run.rowsBetween(Window.unboundedPreceding, -1))
    begins = (reached.isNull() | (F.col("start") >= reached)).cast("int")
    return (edges.withColumn("begins", begins)
            .withColumn("part", F.sum("begins").over(
                run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .groupBy("article_id", "tok_no", "part", "stop")
            .agg(F.min("start").alias("start"), F.max("n").alias("widest"),
                 F.collect_list(F.struct("n", "cost", "word")).alias("ways"))
            .groupBy("article_id", "tok_no", "part")
            .agg(F.min("start").alias("start"), F.max("stop").alias("last"),
                 F.max("widest").alias("widest"),
                 F.sort_array(F.collect_list(F.struct("stop", "ways"))).alias("ends"))
            .where(F.col("widest") > 1)
            .select("article_id", "tok_no", "start", F.col("last").alias("stop"), "widest", "ends"))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def best_path(ends: Column, start: Column, stop: Column, widest: Column, unknown: Column,
              digits: int) -> Column:
    """Words ``array<string>``, each ``offset:word``, of the cheapest way from ``start`` to
    ``stop``.

    Position by position the least cost of getting there (the last ``widest`` of
    them are held) and the length of the last word on the way are noted; the way
    is then read from its end.  Lengths and words are appended to strings, of
    ``digits`` for a length: a step copies them as bytes, where an array would
    be rebuilt element by element.
    """
    none = F.array().cast("array<struct<n:int,cost:bigint,word:string>>")
    size = stop - start

    def forward(acc: Column, at: Column) -> Column:
        end = F.get(ends, acc["next"])
        found = F.coalesce(end["stop"] == start + at, F.lit(False))

        def take(ways: Column) -> Column:
            single = F.struct((F.element_at(acc["cost"], -1) + unknown).alias("cost"),
                              F.lit(-1).alias("order"))
            more = F.transform(ways, lambda w: F.struct(
                (F.element_at(acc["cost"], -w["n"]) + w["cost"]).alias("cost"),
                (-w["n"]).alias("order")))
            return _bind(F.array_min(F.concat(F.array(single), more)), lambda best: F.struct(
                (acc["next"] + F.when(F.size(ways) > 0, 1).otherwise(0)).alias("next"),
                F.slice(F.concat(acc["cost"], F.array(best["cost"])),
                        F.greatest(F.size(acc["cost"]) + 2 - widest, F.lit(1)), widest)
                .alias("cost"),
                F.concat(acc["back"], F.lpad((-best["order"]).cast("string"), digits, "0"))
                .alias("back")))
        return _bind(F.when(found, end["ways"]).otherwise(none), take)

    def backward(back: Column) -> Column:
        def visit(acc: Column, at: Column) -> Column:
            end = F.get(ends, acc["next"])
            passed = acc["next"] - F.when(
                F.coalesce(end["stop"] == start + at, F.lit(False)), 1).otherwise(0)
            skip = F.struct(acc["at"].alias("at"), passed.alias("next"), acc["words"].alias("words"))

            def read(n: Column) -> Column:
                word = F.get(F.filter(end["ways"], lambda w: w["n"] == n), 0)["word"]
                text = F.concat((start + at - n).cast("string"), F.lit(":"), word, F.lit(" "))
                return F.struct(
                    (at - n).alias("at"), passed.alias("next"),
                    F.concat(F.when(n > 1, text).otherwise(F.lit("")), acc["words"]).alias("words"))
            last = F.substring(back, (at - 1) * digits + 1, F.lit(digits)).cast("int")
            return F.when(acc["at"] == at, _bind(last, read)).otherwise(skip)

        begin = F.struct(size.alias("at"), (F.size(ends) - 1).alias("next"), F.lit("").alias("words"))
        return F.aggregate(F.sequence(size, F.lit(1), F.lit(-1)), begin, visit,
                           lambda acc: F.split(F.rtrim(acc["words"]), " "))

    begin = F.struct(F.lit(0).alias("next"), F.array(F.lit(0).cast("long")).alias("cost"),
                     F.lit("").alias("back"))
    way = F.aggregate(F.sequence(F.lit(1), size), begin, forward, lambda acc: acc["back"])
    return F.filter(_bind(way, backward), lambda w: w != "")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of CHARS_AT_ONCE characters of Han runs, or one run more."""
    held, chars = [], 0
    for batch in batches:
        sizes = pc.if_else(batch["han"], pc.utf8_length(batch["token"]), 1)
        ends = np.cumsum(sizes.to_numpy(), dtype=np.int64)
        a = before = 0
        while (b := int(np.searchsorted(ends, before + CHARS_AT_ONCE - chars))) < len(ends):
            yield pa.concat_batches([*held, batch.slice(a, b + 1 - a)])
            held, chars, a, before = [], 0, b + 1, int(ends[b])
        if a < len(ends):
            held.append(batch.slice(a))
            chars += int(ends[-1]) - before
    if held:
        yield pa.concat_batches(held)


def _words_of(runs: pa.RecordBatch, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row of the run, offset in it, word number)`` of the words of Han runs."""
    lengths = pc.utf8_length(runs["token"]).to_numpy().astype(np.int64)
    place, word = words.cheapest(code_points(runs["token"].to_pylist()), lengths)
    ends = np.cumsum(lengths)
    row = np.searchsorted(ends, place, "right")
    return row, place - (ends - lengths)[row], word


def _reader(known: Broadcast) -> Callable:
    """Arrow batches ``(article_id, tok_no, token, han)`` to ``(article_id, tok_no, o, term)``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spelled = known.value
        for batch in _batches(batches):
            plain = batch.filter(pc.invert(batch["han"]))
            yield _terms(plain["article_id"], plain["tok_no"],
                         pa.array(np.zeros(plain.num_rows, np.int32)), plain["token"])
            runs = batch.filter(batch["han"])
            row, offset, word = _words_of(runs, words)
            at = pa.array(row)
            yield _terms(runs["article_id"].take(at), runs["tok_no"].take(at),
                         pa.array(offset.astype(np.int32)), spelled.take(pa.array(word)))
    return read


def _terms(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*columns], ["article_id", "tok_no", "o", "term"])


def _lister(known: Broadcast, min_len: int) -> Callable:
    """Arrow batches ``(article_id, tok_no, token, han)`` to ``(article_id, ats, terms)``: the
    distinct terms that a batch has of an article, each at its first place."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spelled = known.value
        long = pc.greater_equal(pc.utf8_length(spelled), min_len).to_numpy(False)
        for batch in _batches(batches):
            article = batch["article_id"].dictionary_encode()
            number, tok_no = article.indices.to_numpy(), batch["tok_no"].to_numpy()
            han = batch["han"].to_numpy(False)
            row, offset, word = _words_of(batch.filter(batch["han"]), words)
            keep = long[word]
            of_run, offset, word = np.flatnonzero(han)[row[keep]], offset[keep], word[keep]
            plain = np.flatnonzero(~han & pc.greater_equal(
                pc.utf8_length(batch["token"]), min_len).to_numpy(False))
            other = batch["token"].take(pa.array(plain)).dictionary_encode()
            of = np.concatenate([of_run, plain])
            word = np.concatenate([word, other.indices.to_numpy() + np.int32(len(spelled))])
            at = tok_no[of].astype(np.int64) << 32
            at[:len(of_run)] += offset
            yield _listed(article.dictionary, number[of],
                          pa.concat_arrays([spelled, other.dictionary]), word, at)
    return read


def _listed(articles: pa.Array, article: np.ndarray, terms: pa.Array, term: np.ndarray,
            at: np.ndarray) -> pa.RecordBatch:
    """``(article_id, ats, terms)`` of numbered articles and terms, in order of ``at``."""
    order = np.lexsort((at, article))
    article, term, at = article[order].astype(np.int64), term[order], at[order]
    _, first = np.unique(article * len(terms) + term, return_index=True)
    first.sort()
    article, term, at = article[first], term[first], at[first]
    cuts = np.flatnonzero(np.diff(article, prepend=-1))
    ends = pa.array(np.append(cuts, len(article)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [articles.take(pa.array(article[cuts])), pa.ListArray.from_arrays(ends, pa.array(at)),
         pa.ListArray.from_arrays(ends, terms.take(pa.array(term)))],
        names=["article_id", "ats", "terms"])


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers, their bytes plane by plane: most planes are zeros."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _values(raw: memoryview, kind) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed(lists: pa.RecordBatch) -> pa.RecordBatch:
    """``(article_id, n, size, packed)``: lists ``(article_id, ats, terms)``, those of an article
    compressed together, as they are shuffled."""
    codec = pa.Codec("zstd", compression_level=1)
    ends, terms = lists["terms"].offsets.to_numpy(), lists["terms"].values
    at = lists["ats"].values.to_numpy()
    _, offsets, text = terms.buffers()
    offsets = np.frombuffer(offsets, np.int32)[terms.offset:terms.offset + len(terms) + 1]
    text = memoryview(text) if text is not None else b""
    sizes, blocks = [], []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        raw = b"".join([_planes(np.diff(at[a:b], prepend=0)), _planes(np.diff(offsets[a:b + 1])),
                        text[offsets[a]:offsets[b]]])
        sizes.append(len(raw))
        blocks.append(codec.compress(raw, asbytes=True))
    return pa.RecordBatch.from_arrays(
        [lists["article_id"], pa.array(np.diff(ends).astype(np.int32)),
         pa.array(sizes, pa.int32()), pa.array(blocks, pa.binary())],
        names=["article_id", "n", "size", "packed"])


def _unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """What :func:`_packed` has packed."""
    codec = pa.Codec("zstd")
    ats, sizes, texts = [], [], []
    counts = batch["n"].to_numpy()
    for n, size, block in zip(counts.tolist(), batch["size"].to_pylist(), batch["packed"]):
        raw = memoryview(codec.decompress(block.as_buffer(), size))
        ats.append(np.cumsum(_values(raw[:8 * n], np.int64)))
        sizes.append(_values(raw[8 * n:12 * n], np.int32))
        texts.append(raw[12 * n:])
    ends = pa.array(np.cumsum(np.append(0, counts)).astype(np.int32))
    offsets = np.cumsum(np.concatenate([np.zeros(1, np.int32), *sizes]), dtype=np.int64)
    terms = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(b"".join(texts))).cast(pa.string())
    return pa.RecordBatch.from_arrays(
        [batch["article_id"], pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ats))),
         pa.ListArray.from_arrays(ends, terms)], names=["article_id", "ats", "terms"])


def _merged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Lists ``(article_id, ats, terms)``, one for each article."""
    rows = pa.concat_batches(held)
    articles, terms = rows["article_id"].dictionary_encode(), rows["terms"].flatten()
    if len(articles.dictionary) == len(rows["article_id"]):
        return rows
    terms = terms.dictionary_encode()
    return _listed(articles.dictionary, np.repeat(
        articles.indices.to_numpy(), rows["terms"].value_lengths().to_numpy()),
        terms.dictionary, terms.indices.to_numpy(), rows["ats"].flatten().to_numpy())


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists in the order of ``article_id`` -> ``(article_id, pos, term)``.  Holds the
    terms of one article besides a batch."""
    held = None         # of the last article, which may go on
    for batch in batches:
        if not batch.num_rows:
            continue
        # rows of an article stand together, and merged it is one row
        rows = _merged([batch] if held is None else [held, batch])
        held = rows.slice(len(rows["article_id"]) - 1)
        yield _rows(rows.slice(0, len(rows["article_id"]) - 1))
    if held is not None:
        yield _rows(held)


def _rows(lists: pa.RecordBatch) -> pa.RecordBatch:
    sizes = lists["terms"].value_lengths().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]
    return pa.RecordBatch.from_arrays(
        [lists["article_id"].take(pa.array(row)), pa.array(pos.astype(np.int32)),
         lists["terms"].flatten()], names=["article_id", "pos", "term"])


def _for_tasks(dictionary: DataFrame, word_col: str, freq_col: str, max_words: int,
               max_bytes: int) -> tuple[DataFrame, list[int], int, Broadcast | None]:
    """The words' costs, their lengths, the cost of a single character and, if they are
    few enough, the words as they go to the tasks."""
    costs = word_costs(dictionary, word_col, freq_col)
    lengths, unknown = _shape(costs)
    if not fits_broadcast(costs, max_words, max_bytes):
        return costs, lengths, unknown, None
    ship_package(dictionary.sparkSession)
    rows = costs.toArrow()
    words = rows["word"].combine_chunks()
    return costs, lengths, unknown, dictionary.sparkSession.sparkContext.broadcast(
        (Words(words.to_pylist(), rows["cost"].to_numpy(), unknown), words))


def _marked(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``han``, without single Han characters (which are no terms)."""
    marked = tokens.select("article_id", "tok_no", "token", _is_han().alias("han"))
    return marked.where(~F.col("han") | (F.length("token") > 1))


def segment(tokens: DataFrame, dictionary: DataFrame, word_col: str = "word",
            freq_col: str = "freq", max_words: int = TASK_WORDS,
            max_bytes: int = TASK_BYTES) -> DataFrame:
    """``(article_id, tok_no, o, term)``: tokens that are no Han run as they are (at
    offset 0), and of every Han run the dictionary words of more than one character
    on its cheapest path.

    Up to ``max_words`` Han words of ``max_bytes`` (measured) go to the tasks and
    nothing is shuffled; more are joined (:func:`lattice_edges`), with one shuffle of
    the found words by run.  A run is part of one text, so no key grows with the
    corpus.  Without a Han word in the dictionary Han runs give no term.
    """
    costs, lengths, unknown, known = _for_tasks(dictionary, word_col, freq_col, max_words, max_bytes)
    if known is not None:
        return _marked(tokens).mapInArrow(
            _reader(known), "article_id string, tok_no int, o int, term string")
    return _joined(tokens, costs, lengths, unknown)


def _joined(tokens: DataFrame, costs: DataFrame, lengths: list[int], unknown: int) -> DataFrame:
    """:func:`segment` by joins, for a dictionary that is too large for the tasks."""
    runs = tokens.where(_is_han() & (F.length("token") > 1))
    words = stretches(lattice_edges(runs, costs, lengths)).select(
        "article_id", "tok_no", F.explode(best_path(
            F.col("ends"), F.col("start"), F.col("stop"), F.col("widest"),
            F.lit(unknown).cast("long"), len(str(max(lengths, default=1))))).alias("w")).select(
        "article_id", "tok_no", F.substring_index("w", ":", 1).cast("int").alias("o"),
        F.substring_index("w", ":", -1).alias("term"))
    return (tokens.where(~_is_han()).select("article_id", "tok_no", F.lit(0).alias("o"),
                                      F.col("token").alias("term"))
            .unionByName(words))


def segmented_terms(docs: DataFrame, dictionary: DataFrame, id_col: str = "article_id",
                    text_col: str = "content", min_len: int = 2, distinct: bool = True,
                    max_words: int = TASK_WORDS, max_bytes: int = TASK_BYTES) -> DataFrame:
    """``(article_id, pos, term)`` of texts in which Han runs are cut by :func:`segment`;
    ``pos`` numbers an article's terms in text order (with ``distinct`` each once,
    at its first place)."""
    tokens = text_tokens(docs, id_col, text_col)
    costs, lengths, unknown, known = _for_tasks(dictionary, "word", "freq", max_words, max_bytes)
    if known is not None and distinct:
        # an article's terms stay one list until they are numbered: neither a hash table nor
        # a sort of single terms, and one row of an article is shuffled instead of one a term
        read = _lister(known, min_len)
        lists = _marked(tokens).mapInArrow(
            lambda it: map(_packed, read(it)),
            "article_id string, n int, size int, packed binary")
        return lists.repartition("article_id").sortWithinPartitions("article_id").mapInArrow(
            lambda it: _numbered(_unpacked(b) for b in it if b.num_rows),
            "article_id string, pos int, term string")
    terms = (_joined(tokens, costs, lengths, unknown) if known is None else _marked(tokens).mapInArrow(
        _reader(known), "article_id string, tok_no int, o int, term string")).where(
        F.length("term") >= min_len)
    # the place in the text as one number: its least is found in a hash table, without a sort
    at = F.shiftleft(F.col("tok_no").cast("long"), 32) + F.col("o")
    terms = terms.select("article_id", "term", at.alias("at"))
    if distinct:
        terms = terms.groupBy("article_id", "term").agg(F.min("at").alias("at"))
    place = Window.partitionBy("article_id").orderBy("at")
    return terms.select("article_id", (F.row_number().over(place) - 1).alias("pos"), "term")
