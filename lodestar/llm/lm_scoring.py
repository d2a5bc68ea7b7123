"""Language-model scores from a subword lattice.

A text is its words (A-Z in lower case) and one end.  A word's lattice has the
pieces of an existing vocabulary as arcs, the first with the vocabulary's space
in front; its weight sums over *all* segmentations, by a forward recursion in
log space.  The marginal probability of a text is the product of its words'
sums and the end's probability: nothing but pieces spells a word.

Piece probabilities start from the vocabulary's own scores and are re-estimated
from the training documents by ``rounds`` of expectation maximisation: the
expected use of every piece over the segmentations of all training words, as
often as they occur, with the number of texts for the end.  Pieces, bytes and the
end share one distribution.

Scoring runs per distinct word, not per occurrence:

* one table of distinct words with their training counts, aggregated by Spark;
* the most frequent ``frequent`` words (a fixed number) are broadcast with
  their scores, so common words need no shuffle;
* every other word of every document joins the word table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm._spark import in_tasks, joined, remainder, saved
from lodestar.llm._text import Words, row_blocks
from lodestar.llm.lattice import (
    SPACE, Pieces, expected_counts, load_vocabulary, log_marginals,
)

FREQUENT = 1 << 17      # words that are broadcast; at most 2**17 words of MAX_SENT characters
MAX_SENT = 64
ROUNDS = 2
SMOOTHING = 0.1
LOG10 = math.log(10)


def is_held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return remainder(doc_id, folds) == F.lit(fold)


def _count_words(batches):
    """Distinct words of each block with their counts in training and other texts."""
    for batch in batches:
        column, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        for first, last in row_blocks(column):
            words = Words(column.slice(first, last - first), lower=True)
            if not len(words):
                continue
            coded = words.arrow().dictionary_encode()
            index = coded.indices.to_numpy(zero_copy_only=False)
            size = len(coded.dictionary)
            every = np.bincount(index, minlength=size)
            trained = np.bincount(index[~held[first:last][words.doc]], minlength=size)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.cast(pa.string()), pa.array(trained), pa.array(every)],
                names=["word", "trained", "every"])


class Lattice:
    """The model; as large as the vocabulary, sent to the tasks."""

    def __init__(self, path: str, tokens: int, types: int, ends: int):
        self.tokens, self.types, self.ends = tokens, types, ends
        self.pieces, _ = load_vocabulary(path)
        # the vocabulary's scores are ranks: start from the inverse rank, as if
        # each training word were one piece
        first = self.pieces.scores[:-1]
        start = 1.0 / (1.0 + first.max() - first)
        self.fit(start * max(tokens - ends, 1) / start.sum(), np.zeros(256))

    def fit(self, counts: np.ndarray, byte_counts: np.ndarray) -> None:
        """Probabilities from (expected) counts of the pieces, in the order of the sorted keys."""
        counts, byte_counts, end = counts + SMOOTHING, byte_counts + SMOOTHING, self.ends + SMOOTHING
        total = math.log(counts.sum() + byte_counts.sum() + end)
        self.pieces.scores[:-1] = np.log(counts) - total
        self.pieces.byte_scores = np.log(byte_counts) - total
        self.end = math.log(end) - total

    def log10(self, words: list[str]) -> np.ndarray:
        """log10 of the summed weight of all segmentations of each word."""
        return log_marginals(self.pieces, [SPACE + w for w in words]) / LOG10


def _expect(batches, model):
    """Expected use of every piece and byte over this partition's training words."""
    lattice: Pieces = model.value.pieces
    total = np.zeros(len(lattice.keys) + 256)
    for batch in joined(batches):
        words = [SPACE + w for w in batch.column(0).to_pylist()]
        total += np.concatenate(expected_counts(lattice, words, batch.column(1).to_numpy()))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["piece", "n"])


def train(words: DataFrame, train_docs: int, path: str, rounds: int = ROUNDS) -> Lattice:
    """Fit the model to ``words`` (``word``, ``trained``) and the number of texts.

    What reaches the driver is one number for each piece of the vocabulary.
    """
    spark = words.sparkSession
    known = words.where("trained > 0")
    totals = known.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count(F.lit(1))).first()
    model = Lattice(path, totals[0] + train_docs, totals[1] + (train_docs > 0), train_docs)
    size = len(model.pieces.keys)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        counts = np.zeros(size + 256)
        for r in (known.select("word", "trained")
                  .transform(in_tasks, lambda it: _expect(it, sent), "piece long, n double")
                  .groupBy("piece").agg(F.sum("n").alias("n")).collect()):
            counts[r["piece"]] = r["n"]
        if counts.any():
            model.fit(counts[:size], counts[size:])
    return model


def _step() -> Column:
    """A word's count on a logarithmic scale: at most some 1,400 steps for any count."""
    return F.floor(F.log(F.col("every").cast("double")) * 32)


def _edge(words: DataFrame, frequent: int) -> int:
    """The least step from which on at most ``frequent`` words remain."""
    left, edge = frequent, 1 << 30
    for r in words.groupBy(_step().alias("step")).count().orderBy(F.col("step").desc()).collect():
        left -= r["count"]
        if left < 0:
            break
        edge = r["step"]
    return edge


def _look_up(batches, frequent):
    """Per text the sums over its frequent words; per rare word of it a row of its own.

    A text's own row has a key that no word can be (it holds a space), so
    rows of all kinds spread evenly over the join.
    """
    table, bases, scores = frequent.value
    index = {w: i for i, w in enumerate(table)}
    for batch in batches:
        column = batch.column(2)
        for first, last in row_blocks(column):
            n = last - first
            words = Words(column.slice(first, n), lower=True)
            key, key2 = (batch.column(i).slice(first, n) for i in (0, 1))
            coded = words.arrow().dictionary_encode()
            unique = coded.dictionary.to_pylist()
            number = np.array([index.get(w, -1) for w in unique], np.int64)
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            which = number[code] if len(code) else np.zeros(0, np.int64)
            hit = which >= 0
            doc = words.doc[hit]
            sums = [np.bincount(doc, x, n) for x in (
                bases[0][which[hit]], scores[which[hit]], bases[1][which[hit]])]
            rare_doc, rare_code = words.doc[~hit], code[~hit]
            pair, times = np.unique(rare_doc * max(len(unique), 1) + rare_code, return_counts=True)
            rare_doc, rare_code = pair // max(len(unique), 1), pair % max(len(unique), 1)
            m = len(pair)
            rare = pa.array(rare_doc)
            yield pa.RecordBatch.from_arrays(
                [*[pa.concat_arrays([k, k.take(rare)]) for k in (key, key2)],
                 pa.concat_arrays([pc.binary_join_element_wise(
                     key.cast(pa.string()), pa.array([" "] * n), ""),
                     coded.dictionary.cast(pa.string()).take(pa.array(rare_code))]),
                 pa.array(np.concatenate((words.counts, np.zeros(m, np.int64)))),
                 pa.array(np.concatenate((np.zeros(n, np.int64), times))),
                 *[pa.array(np.concatenate((x, np.zeros(m)))) for x in sums]],
                names=["key", "key2", "word", "n_words", "times", "base", "model", "known"])


def score_documents(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id",
                    held_out: Column | None = None, rounds: int = ROUNDS,
                    frequent: int = FREQUENT) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    ``score`` is the log10 of the text's marginal probability (all segmentations of
    its words, and its end), ``base_score`` that of the smoothed word-unigram
    baseline.  ``rounds=0`` keeps the vocabulary's own scores.
    Learns from the rows that are not ``held_out`` (default: crc32 of the id,
    a null id being '', modulo 5 is 1).  A null text counts as empty: one
    token, its end.  Repeated rows count and are returned as often as they
    occur.  An empty table gives an empty result; other columns play no part.
    """
    spark = docs.sparkSession
    held = is_held_out(F.col(id_col)) if held_out is None else held_out
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
                       text.alias("text"))
    words = saved(rows.select("text", "held_out")
                  .transform(in_tasks, _count_words, "word string, trained long, every long")
                  .groupBy("word").agg(F.sum("trained").alias("trained"),
                                       F.sum("every").alias("every")))
    train_docs = rows.where(~F.col("held_out")).count()
    model = train(words, train_docs, path, rounds)
    n = model.tokens
    below = math.log10(n + 0.5 * (model.types + 1))

    edge = _edge(words, frequent)
    is_top = (F.col("step") >= edge) & (F.length("word") <= MAX_SENT)
    stepped = words.withColumn("step", _step())
    top = stepped.where(is_top).select("word", "trained").collect()
    table = [r["word"] for r in top]
    trained = np.array([r["trained"] for r in top], np.float64)
    sent = spark.sparkContext.broadcast(
        (table, (np.log10(trained + 0.5), (trained > 0).astype(np.float64)),
         model.log10(table)))
    lattice = spark.sparkContext.broadcast(model)

    def marginals(batches):
        for batch in joined(batches):
            score = lattice.value.log10(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score)],
                names=["word", "trained", "log10"])

    rest = (stepped.where(~is_top).select("word", "trained")
            .transform(in_tasks, marginals, "word string, trained long, log10 double"))
    # rows of one key (128 bits) are repetitions of one row; their sums are divided again
    key = ["key", "key2"]
    keyed = rows.select("*", F.xxhash64("doc_id", "text").alias("key"),
                        F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text")).alias("key2"))
    found = (keyed.select(*key, "text")
             .transform(in_tasks, lambda it: _look_up(it, sent),
                         "key long, key2 long, word string, n_words long, times long, "
                         "base double, model double, known double")
             .join(rest, "word", "left"))
    times = F.col("times")
    sums = found.groupBy(*key).agg(
        F.count(F.when(times == 0, 1)).alias("copies"),
        F.sum("n_words").alias("n_words"),
        F.sum(F.col("base") + times * F.coalesce(F.log10(F.col("trained") + 0.5), F.lit(0.0)))
        .alias("base"),
        F.sum(F.col("model") + times * F.coalesce("log10", F.lit(0.0))).alias("model"),
        F.sum(F.col("known") + F.when(F.col("trained") > 0, times).otherwise(0)).alias("known"))
    end_known = 1 if train_docs > 0 else 0
    per_text = sums.select(
        *key, (F.col("n_words") / F.col("copies")).cast("long").alias("n_words"),
        (F.col("base") / F.col("copies")).alias("base"),
        (F.col("model") / F.col("copies")).alias("model"),
        F.round(F.col("known") / F.col("copies")).cast("long").alias("known"))
    n_tokens = F.col("n_words") + 1
    return (keyed.select("doc_id", "held_out", *key).join(per_text, key).select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"),
        (F.col("known") + end_known).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(math.log10(train_docs + 0.5)) - n_tokens * F.lit(below))
        .alias("base_score"),
        (F.col("model") + F.lit(model.end / LOG10)).alias("score")))
