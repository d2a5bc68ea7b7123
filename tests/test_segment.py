"""One segmentation of Han text, against a plain Viterbi over the same dictionary."""

import math
import os
import re

import pytest
import regex

from lodestar.operators import content_terms, terms_by_article
from lodestar.operators.segment import segment, segmented_terms, text_tokens, word_costs
from lodestar.plans import warehouse as W

SF = "/root/testdata/sf0.001"
HAN = regex.compile(r"\p{Han}+")


def costs_of(words):
    """Cost of every Han word of (word, freq) rows, and of a character that is none."""
    freq = {}
    for w, f in words:
        if HAN.fullmatch(w):
            freq[w] = max(freq.get(w, 0), f or 0)
    total = sum(freq.values()) + len(freq)
    costs = {w: math.floor(-math.log((f + 1.0) / total) * 1_000_000 + 0.5) for w, f in freq.items()}
    return costs, 1 + max(costs.values(), default=0)


def viterbi(run, costs, unknown):
    """(offset, word) of the cheapest segmentation; the longer last word wins a tie."""
    longest = max(map(len, costs), default=1)
    best, back = [0], [0]
    for e in range(1, len(run) + 1):
        ways = [(best[e - 1] + unknown, -1)]
        ways += [(best[e - n] + costs[run[e - n:e]], -n) for n in range(1, min(longest, e) + 1)
                 if run[e - n:e] in costs]
        cost, order = min(ways)
        best.append(cost)
        back.append(-order)
    out, e = [], len(run)
    while e:
        out.append((e - back[e], run[e - back[e]:e]))
        e -= back[e]
    return [(o, w) for o, w in reversed(out) if len(w) > 1]


def terms_of(text, costs, unknown):
    out = []
    for part in regex.split(r"[^\p{L}\p{N}]+", regex.sub(r"(\p{Han}+)", r" \1 ", text.lower())):
        out += [w for _, w in viterbi(part, costs, unknown)] if HAN.fullmatch(part) else [part]
    return [t for t in dict.fromkeys(out) if len(t) > 1]


def dictionary(spark, words):
    return spark.createDataFrame(words, "word string, pos string, freq long")


WORDS = [("研究", "n", 400), ("研究生", "n", 90), ("生命", "n", 300), ("命", "n", 50), ("起源", "n", 120),
         ("的", "u", 5000), ("人民", "n", 500), ("人民政府", "nt", 60), ("政府", "n", 300),
         ("新疆维吾尔自治区人民政府", "nt", 3), ("自治区", "n", 40), ("经济", "n", None), ("iphone", "n", 9),
         ("讨论", "v", 80)]


def test_ambiguous_text_has_one_reading(spark):
    text = "研究生命的起源"                 # 研究 | 生命, not 研究生 | 命
    docs = spark.createDataFrame([("a", text), ("b", "讨论新疆维吾尔自治区人民政府经济iPhone新款。人民政府")],
                                 "article_id string, content string")
    terms = content_terms(docs, None, dictionary(spark, WORDS), han="lattice")
    got = {r.article_id: r.terms for r in terms_by_article(terms).collect()}
    assert got == {"a": ["研究", "生命", "起源"],
                   "b": ["新疆维吾尔自治区人民政府", "经济", "iphone", "人民政府"]}
    # the substrings of the long word are no terms, as they are among the candidates
    many = content_terms(docs, None, dictionary(spark, WORDS))
    assert {"人民", "政府", "自治区"} <= {r.term for r in many.collect()}


def test_awkward_texts_match_viterbi(spark):
    words = WORDS + [("人人", "n", 5), ("人", "n", 7), ("生", "n", 1)]
    texts = ["", "的", "命命命", "人" * 301, "人民人民政府政府人", "研究生研究生命命", "x研究y人民z 2024人民",
             "自治区" * 40 + "人民政府", "天地玄黄", "经济，经济。经济"]
    docs = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)] + [("n", None), (None, "人民")],
                                 "article_id string, content string")
    costs, unknown = costs_of([(w, f) for w, _, f in words])
    got = {}
    rows = segmented_terms(docs, dictionary(spark, words)).collect()
    for r in sorted(rows, key=lambda r: r.pos):
        got.setdefault(r.article_id, []).append(r.term)
        assert r.pos == len(got[r.article_id]) - 1
    want = {str(i): terms_of(t, costs, unknown) for i, t in enumerate(texts)}
    assert got == {i: t for i, t in want.items() if t}


def test_every_occurrence_is_kept_on_request(spark):
    docs = spark.createDataFrame([("a", "人民政府人民，人民")], "article_id string, content string")
    rows = segmented_terms(docs, dictionary(spark, WORDS), distinct=False).collect()
    assert [r.term for r in sorted(rows, key=lambda r: r.pos)] == ["人民政府", "人民", "人民"]


def test_without_words_or_frequencies(spark):
    docs = spark.createDataFrame([("a", "人民政府 plain text")], "article_id string, content string")
    none = spark.createDataFrame([], "word string, pos string, freq long")
    tokens = text_tokens(docs)
    assert sorted(r.term for r in segment(tokens, none).collect()) == ["plain", "text"]
    bare = spark.createDataFrame([("人民", "n"), ("政府", "n"), ("plain", "n")], "word string, pos string")
    assert {r.cost for r in word_costs(bare).collect()} == {round(math.log(2) * 1_000_000)}
    assert sorted(r.term for r in segment(tokens, bare).collect()) == ["plain", "text", "人民", "政府"]


def test_runs_are_read_in_the_tasks_or_joined(spark):
    words = WORDS + [("人人", "n", 5), ("人", "n", 7), ("𠀀𠀁", "n", 4)]
    texts = ["人民人民政府政府人", "人" * 301, "研究生命的起源 plain", "x研究𠀀𠀁y𠀁人民z", "的", "天地玄黄"]
    docs = spark.createDataFrame(list(enumerate(texts)), "article_id int, content string")
    tokens = text_tokens(docs)
    read = segment(tokens, dictionary(spark, words))
    joined = segment(tokens, dictionary(spark, words), max_words=5)
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (read, joined)]
    # no candidate substring becomes a row
    assert "MapInArrow" in plans[0] and "Join" not in plans[0] and "Join" in plans[1]
    rows = sorted(map(tuple, read.collect()))
    assert rows == sorted(map(tuple, joined.collect()))
    assert "𠀀𠀁" in {w for *_, w in rows}
    # of two texts with one id each is read by itself
    same = spark.createDataFrame([(7, "研究"), (7, "生命")], "article_id int, content string")
    assert sorted(r.term for r in segment(text_tokens(same), dictionary(spark, words)).collect()) == [
        "生命", "研究"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_query_matches_viterbi_on_the_whole_table(spark):
    from lodestar.plans.registry import QUERIES

    got = {}
    for r in sorted(QUERIES["content_terms_han"](spark, SF).collect(), key=lambda r: r.pos):
        got.setdefault(r.article_id, []).append(r.term)
    words = [(r.word, r.pos, r.freq) for r in W.han_dictionary(spark, SF).collect()]
    stop = {r.word for r in W.han_stopwords(spark, SF).collect()}
    nouns = {w for w, p, _ in words if p.startswith("n")}
    costs, unknown = costs_of([(w, f) for w, _, f in words])
    want = {}
    for r in W.han_articles(spark, SF).where("content IS NOT NULL").collect():
        terms = [t for t in terms_of(r.content, costs, unknown) if t in nouns and t not in stop]
        if terms:
            want[r.article_id] = terms
    assert got == want
    assert max(len(t) for x in got.values() for t in x if re.fullmatch(HAN.pattern.replace(
        r"\p{Han}", "[一-龥]"), t)) >= 9
