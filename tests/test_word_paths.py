"""Cheapest paths of many runs at once, against a loop over one run's places."""

import random

import numpy as np
import pyarrow as pa
import pytest

from lodestar.operators import segment
from lodestar.operators.word_paths import Steps, Words, code_points


def one_run(run, costs, unknown):
    """(offset, word): ways to a place are tried from the longest last word on."""
    longest = max(map(len, costs), default=1)
    best, back = [0], [0]
    for end in range(1, len(run) + 1):
        ways = [(best[end - n] + (min(unknown, costs.get(run[end - 1], unknown)) if n == 1
                                  else costs[run[end - n:end]]), -n)
                for n in range(1, min(longest, end) + 1) if n == 1 or run[end - n:end] in costs]
        cost, less = min(ways)
        best.append(cost)
        back.append(-less)
    out, end = [], len(run)
    while end:
        if back[end] > 1:
            out.append((end - back[end], run[end - back[end]:end]))
        end -= back[end]
    return out[::-1]


def many_runs(runs, costs, unknown):
    words = list(costs)
    lengths = np.array([len(r) for r in runs], np.int64)
    place, word = Words(words, [costs[w] for w in words], unknown).cheapest(code_points(runs), lengths)
    first = np.cumsum(lengths) - lengths
    out = [[] for _ in runs]
    for p, w in zip(place.tolist(), word.tolist()):
        row = int(np.searchsorted(first + lengths, p, "right"))
        out[row].append((p - int(first[row]), words[w]))
    return out


@pytest.mark.parametrize("letters, longest, words", [("ab", 4, 12), ("abc", 6, 60), ("山水𠀀火", 3, 9), ("a", 5, 5)])
def test_same_as_one_run_at_a_time(letters, longest, words):
    rnd = random.Random(letters + str(longest))
    for _ in range(60):
        costs = {"".join(rnd.choices(letters, k=rnd.randint(1, longest))): rnd.randint(0, 4)
                 for _ in range(words)}
        unknown = 1 + max(costs.values())
        runs = ["".join(rnd.choices(letters + "z", k=rnd.choice([1, 2, 3, 9, 40])))
                for _ in range(rnd.randint(1, 12))]
        assert many_runs(runs, costs, unknown) == [one_run(r, costs, unknown) for r in runs]


def test_long_run_without_a_gap():
    costs = {"ab": 2, "ba": 2, "aba": 3, "b": 1}
    run = "ab" * 40_000       # more places than 16 bits count
    (got,) = many_runs([run], costs, 5)
    assert got == one_run(run, costs, 5)


def test_no_words_and_no_runs():
    assert many_runs(["abc", "d"], {}, 1) == [[], []]
    place, word = Words(["ab"], [1], 2).cheapest(code_points([]), np.zeros(0, np.int64))
    assert len(place) == len(word) == 0


def test_steps_find_every_key_and_no_other():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    steps = Steps(keys)
    assert (steps.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.random.default_rng(2).integers(0, 1 << 40, 5000), keys)
    assert (steps.find(other) == -1).all()


def batch(rows):
    return pa.RecordBatch.from_pylist(
        [dict(zip(["article_id", "tok_no", "token", "han"], r)) for r in rows], schema=pa.schema(
            [("article_id", pa.string()), ("tok_no", pa.int32()), ("token", pa.string()),
             ("han", pa.bool_())]))


class Sent:
    def __init__(self, words):
        self.value = Words(words, [1] * len(words), 9), pa.array(words, pa.string())


def test_a_task_sends_an_article_as_one_list():
    """One word said 500 times is one term of one row after the tasks, not 500 rows."""
    rows = [("a", i, "人民", True) for i in range(500)] + [("b", 0, "plain", False), ("b", 1, "x", False)]
    # a text of the same article that comes later counts from its own beginning
    rows += [("a", 3, "other", False), ("a", 4, "人民人民", True), ("a", 2, "plain", False)]
    (out,) = segment._lister(Sent(["人民"]), 2)([batch(rows)])
    assert out.to_pylist() == [
        {"article_id": "a", "ats": [0, 2 << 32, 3 << 32], "terms": ["人民", "plain", "other"]},
        {"article_id": "b", "ats": [0], "terms": ["plain"]}]


def test_lists_of_an_article_in_several_batches_are_one():
    def lists(*rows):
        return pa.RecordBatch.from_pylist(
            [dict(zip(["article_id", "ats", "terms"], r)) for r in rows],
            schema=pa.schema([("article_id", pa.string()), ("ats", pa.list_(pa.int64())),
                              ("terms", pa.list_(pa.string()))]))

    batches = [lists(("a", [1, 5], ["x", "y"]), ("b", [7], ["z"])), lists(),
               lists(("b", [2, 9], ["y", "z"])), lists(("b", [1], ["q"]), ("c", [0], ["x"]))]
    out = pa.Table.from_batches(segment._numbered(iter(batches))).to_pylist()
    assert [tuple(r.values()) for r in out] == [
        ("a", 0, "x"), ("a", 1, "y"), ("b", 0, "q"), ("b", 1, "y"), ("b", 2, "z"), ("c", 0, "x")]


def test_same_terms_however_the_dictionary_is_read(spark, monkeypatch):
    """Small batches; lists against joins, and against single terms for repeated ids."""
    monkeypatch.setattr(segment, "CHARS_AT_ONCE", 7)
    words = spark.createDataFrame([("人民", 3), ("民政", 9), ("政府", 2), ("水", 1)],
                                  "word string, freq long")
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("人民政府水山，x1 ", k=rnd.randint(0, 40))) for _ in range(30)]

    def docs(ids):
        return spark.createDataFrame([*zip(ids, texts), ("e", None)],
                                     "article_id string, content string")

    def read(df, **limits):
        return sorted((r.article_id, r.pos, r.term)
                      for r in segment.segmented_terms(df, words, **limits).collect())

    own = docs([str(i) if i % 7 else None for i in range(30)])
    assert read(own) == read(own, max_words=1) != []
    shared = docs(rnd.choices("abc", k=30))
    first = {}
    for r in segment.segment(segment.text_tokens(shared), words).collect():
        if len(r.term) > 1:
            key = r.article_id, r.term
            first[key] = min(first.get(key, (r.tok_no, r.o)), (r.tok_no, r.o))
    got = read(shared)
    assert sorted((a, t) for a, _, t in got) == sorted(first)
    for a in "abc":
        assert [p for b, p, _ in got if a == b] == list(range(sum(a == b for b, _, _ in got)))
        places = [first[b, t] for b, _, t in got if a == b]
        assert places == sorted(places)
