"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in blocks of ``BLOCK`` positions, one
GRU forwards and one backwards, and gives every position a distribution over
the languages from both states.  A document's probabilities are the mean over
all its positions that are not white space, so every byte of every whole text
is read, and the work is linear in the bytes.

Training is numpy backpropagation through time with Adam, on the driver, on a
bounded sample (parameters ``docs_per_language`` and ``sample_chars``).
Scoring runs in Arrow tasks; the blocks of many documents advance together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lodestar.llm._spark import in_tasks, remainder
from lodestar.llm._text import WHITE_SPACE, row_blocks, utf8_parts

BLOCK = 64                # positions that are read in one go
HIDDEN = 8                # units of each direction
DOCS_PER_LANGUAGE = 400   # training documents of each language, by hash of their id
SAMPLE_CHARS = 512        # characters of each, from a place that the hash gives
STEPS = 220
BATCH = 256
BLOCKS_AT_ONCE = 2048
_SHARES = 1 << 30
UNDETERMINED = "und"
# Fixed value: a text without a letter of any script has no language.
LETTER = r"\p{L}"

_SOLID = np.ones(256, np.float32)
_SOLID[list(WHITE_SPACE)] = 0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)
    return x


class Gru:
    """One direction: ``inputs`` (256 x 3H) are the bytes' gate inputs, ``state``
    (H x 3H) the recurrent weights; gates in the order update, reset, candidate."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.inputs = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
        self.state = rng.normal(0, 0.6 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)

    def run(self, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (time x H x rows) after each step for ``steps`` (time x rows of bytes).

        Units are the first axis throughout, so that a gate of all rows is one
        contiguous piece of memory.
        """
        t, n = steps.shape
        h2 = 2 * (size := self.state.shape[0])
        inputs, state = np.ascontiguousarray(self.inputs.T), np.ascontiguousarray(self.state.T)
        places = steps.astype(np.intp)
        out = np.empty((t, size, n), np.float32)
        h = np.zeros((size, n), np.float32)
        for i in range(t):
            x = inputs.take(places[i], axis=1, mode="clip")
            u = state @ h
            gates = x[:h2]
            gates += u[:h2]
            _sigmoid(gates)
            z, r = gates[:size], gates[size:]
            c = r * u[h2:]
            c += x[h2:]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, z, r, c, u[h2:]))
            new = out[i]
            np.subtract(h, c, out=new)
            new *= z
            new += c
            h = new
        return out

    def back(self, steps: np.ndarray, kept: list, d_out: np.ndarray) -> tuple:
        """Gradients of ``inputs`` and ``state`` by backpropagation through time."""
        size = self.state.shape[0]
        d_inputs, d_state = np.zeros_like(self.inputs), np.zeros_like(self.state)
        d_h = np.zeros_like(d_out[0])
        for i in range(len(steps) - 1, -1, -1):
            before, z, r, c, uc = kept[i]
            d_h = d_h + d_out[i]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_z = d_h * (before - c) * z * (1 - z)
            d_r = d_c * uc * r * (1 - r)
            d_x = np.concatenate((d_z, d_r, d_c))
            d_u = np.concatenate((d_z, d_r, d_c * r))
            np.add.at(d_inputs, steps[i], d_x.T)
            d_state += before @ d_u.T
            d_h = d_h * z + self.state @ d_u
        return d_inputs, d_state


class Network:
    """Both directions and the labelling layer."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = Gru(rng, hidden), Gru(rng, hidden)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _parameters(self) -> list[np.ndarray]:
        return [self.forward.inputs, self.forward.state, self.backward.inputs,
                self.backward.state, self.out, self.bias]

    def label(self, blocks: np.ndarray, keep: tuple | None = None) -> tuple:
        """Probabilities (time x languages x rows) of every position of ``blocks``,
        and the states that they were made from."""
        steps = np.ascontiguousarray(blocks.T)
        kept_ahead, kept_behind = keep or (None, None)
        ahead = self.forward.run(steps, kept_ahead)
        behind = self.backward.run(steps[::-1], kept_behind)[::-1]
        size = ahead.shape[1]
        p = self.out[:size].T @ ahead
        p += self.out[size:].T @ behind
        p += self.bias[:, None]
        top = p[:, 0].copy()
        for k in range(1, p.shape[1]):
            np.maximum(top, p[:, k], out=top)
        p -= top[:, None]
        np.exp(p, out=p)
        p /= p.sum(axis=1)[:, None]
        return p, ahead, behind

    def _gradients(self, blocks: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        kept: tuple[list, list] = ([], [])
        p, ahead, behind = self.label(blocks, kept)
        steps = np.ascontiguousarray(blocks.T)
        p[:, target, np.arange(len(target))] -= 1
        weight = _SOLID[steps][:, None]
        p *= weight / max(float(weight.sum()), 1.0)
        d_both = self.out @ p
        size = ahead.shape[1]
        d_out = np.concatenate((np.einsum("thn,tln->hl", ahead, p, optimize=True),
                                np.einsum("thn,tln->hl", behind, p, optimize=True)))
        return [*self.forward.back(steps, kept[0], d_both[:, :size]),
                *self.backward.back(steps[::-1], kept[1], d_both[::-1, size:]),
                d_out, p.sum(axis=(0, 2))]

    def train(self, blocks: np.ndarray, target: np.ndarray, steps: int = STEPS,
              batch: int = BATCH, rate: float = 0.03, seed: int = 11) -> "Network":
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self._parameters()]
        second = [np.zeros_like(w) for w in self._parameters()]
        for step in range(1, steps + 1):
            some = rng.integers(0, len(target), batch)
            grads = self._gradients(blocks[some], target[some])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            lr = rate * min(1.0, 3 * (1 - step / (steps + 1)))
            for w, g, m, v in zip(self._parameters(), grads, first, second):
                g = g * min(1.0, 1.0 / (norm + 1e-9))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= lr * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self

    def pooled(self, column: pa.Array) -> np.ndarray:
        """Mean label probabilities (rows x languages) over the whole text of each row."""
        data, bounds = utf8_parts(column)
        n = len(bounds) - 1
        per_row = -(-np.diff(bounds) // BLOCK)
        row = np.repeat(np.arange(n), per_row)
        begin = bounds[:-1][row] + BLOCK * (np.arange(len(row)) - (np.cumsum(per_row) - per_row)[row])
        size = np.minimum(bounds[1:][row] - begin, BLOCK)
        padded = np.concatenate((data, np.full(BLOCK, 32, np.uint8)))
        total = np.zeros((n, len(self.languages)))
        weight = np.zeros(n)
        # full blocks go together; last blocks are sorted so that little is padded
        order = np.argsort(-size, kind="stable")
        for a in range(0, len(order), BLOCKS_AT_ONCE):
            some = order[a:a + BLOCKS_AT_ONCE]
            width = int(size[some[0]])
            place = np.arange(width)
            blocks = padded[begin[some][:, None] + place]
            inside = place < size[some][:, None]
            blocks[~inside] = 32
            w = _SOLID[blocks].T * inside.T
            p = self.label(blocks)[0]
            p *= w[:, None]
            pooled = p.sum(axis=0).T
            np.add.at(total, row[some], pooled)
            np.add.at(weight, row[some], w.sum(axis=0))
        return total / np.maximum(weight, 1)[:, None]


def is_held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return remainder(doc_id, folds) == F.lit(fold)


def training_sample(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE,
                    chars: int = SAMPLE_CHARS) -> DataFrame:
    """``(lang, text)``: up to ``docs_per_language`` documents of each language, by
    hash of their id, and ``chars`` characters of each from a hashed place on.

    A share of each language that holds about four times as many is taken
    first, so that what is ranked does not grow with the table.
    """
    counts = docs.where("lang IS NOT NULL").groupBy("lang").count().collect()
    if not counts:
        return docs.select("lang", "text").limit(0)
    share = F.create_map(*[F.lit(x) for r in counts for x in (
        r["lang"], min(_SHARES, -(-4 * docs_per_language * _SHARES // r["count"])))])
    h = F.xxhash64("doc_id", "text")
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    return (docs.where("lang IS NOT NULL").withColumn("h", h)
            .where(F.pmod("h", F.lit(_SHARES)) < share[F.col("lang")])
            .where(F.col("text").rlike(LETTER))
            .select("lang", "doc_id", "h", F.substring(
                "text", (F.pmod("h", F.greatest(F.length("text") - chars, F.lit(1))) + 1)
                .cast("int"), F.lit(chars)).alias("text"))
            .withColumn("at", F.row_number().over(order))
            .where(F.col("at") <= docs_per_language).select("lang", "text"))


def train(sample: list[tuple[str, str]], hidden: int = HIDDEN, steps: int = STEPS) -> Network | None:
    """Fit a network to ``(lang, text)`` pairs; None without any."""
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return None
    blocks, target = [], []
    for lang, text in sorted(sample):
        raw = np.frombuffer(text.encode(), np.uint8)
        raw = np.concatenate((raw, np.full(-len(raw) % BLOCK, 32, np.uint8))).reshape(-1, BLOCK)
        blocks.append(raw)
        target += [languages.index(lang)] * len(raw)
    return Network(languages, hidden).train(np.concatenate(blocks), np.array(target), steps)


def _predict(batches, sent, at: int, names: list[str]):
    """Every batch with its rows' language and score in place of the last column,
    which tells whether a row's text (column ``at``) has a letter."""
    network: Network | None = sent.value
    for batch in batches:
        column = batch.column(at)
        some = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        lang, score = np.full(len(some), UNDETERMINED, object), np.zeros(len(some))
        if network is not None and some.any():
            p = np.concatenate([network.pooled(column.slice(first, last - first))
                                for first, last in row_blocks(column)])
            best = p.argmax(axis=1)
            lang[some] = np.array(network.languages, object)[best[some]]
            score[some] = np.clip(p[np.arange(len(p)), best][some], 0, 1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(lang.tolist(), pa.string()), pa.array(score)],
            names=names)


def add_language(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                 lang_col: str = "lang", held_out: Column | None = None,
                 docs_per_language: int = DOCS_PER_LANGUAGE, hidden: int = HIDDEN,
                 steps: int = STEPS, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the columns ``names``, by default ``lang_pred`` and ``score``
    (columns of these names are replaced).

    Learns from rows that are not ``held_out`` (default: crc32 of the id, a
    null id being '', modulo 3 is 1) and have a language.  ``lang_pred`` is a
    learned language, or ``und`` with score 0 for a null text, one without a
    letter, and any text if nothing could be learned.  The language, source
    and id of a row have no influence on its prediction.  Repeated rows are
    predicted alike; an empty table gives an empty result.
    """
    sent = _learned(docs, text_col, id_col, lang_col, held_out, docs_per_language, hidden, steps)
    return _with_language(docs, sent, text_col, names)


def _learned(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             lang_col: str = "lang", held_out: Column | None = None,
             docs_per_language: int = DOCS_PER_LANGUAGE, hidden: int = HIDDEN,
             steps: int = STEPS):
    """The network as a broadcast; its value is None if nothing could be learned."""
    held = is_held_out(F.col(id_col)) if held_out is None else held_out
    learn = docs.where(~held).select(F.col(id_col).cast("long").alias("doc_id"),
                                     _text(text_col).alias("text"),
                                     F.col(lang_col).cast("string").alias("lang"))
    sample = [(r["lang"], r["text"]) for r in training_sample(learn, docs_per_language).collect()]
    return docs.sparkSession.sparkContext.broadcast(train(sample, hidden, steps))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _with_language(docs: DataFrame, sent, text_col: str, names: tuple[str, str]) -> DataFrame:
    kept = docs.drop(*names)
    at = kept.columns.index(text_col)
    schema = StructType([*kept.schema.fields, StructField(names[0], StringType()),
                         StructField(names[1], DoubleType())])
    return (kept.select(*[f"`{c}`" for c in kept.columns],
                        _text(text_col).rlike(LETTER).alias("__lettered"))
            .transform(in_tasks, lambda it: _predict(it, sent, at, schema.names), schema))


def identify(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             lang_col: str = "lang", held_out: Column | None = None, **options) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row; see :func:`add_language`."""
    held = is_held_out(F.col(id_col)) if held_out is None else held_out
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"), held.alias("held_out"))
    return (add_language(rows, held_out=F.col("held_out"), **options)
            .select("doc_id", "held_out", "lang_pred", "score"))


def keep_identified(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose language cannot be determined: those without a
    letter.  If nothing could be learned, this holds just the same."""
    sent = _learned(docs, text_col, **options)
    if sent.value is None:
        return docs.where(_text(text_col).rlike(LETTER))
    return (_with_language(docs, sent, text_col, ("__lang_pred", "__score"))
            .where(F.col("__lang_pred") != UNDETERMINED).select(*[f"`{c}`" for c in docs.columns]))
