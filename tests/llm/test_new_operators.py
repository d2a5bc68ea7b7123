"""Fill-in-the-middle, alignment of tokenizers and the prefix forest against brute force."""

import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from test_operators import awkward, key, same  # noqa: E402

from lodestar.llm import fill_in_middle, prefix_forest, token_alignment  # noqa: E402
from lodestar.llm import queries as llm_queries  # noqa: E402

# names that the operators use themselves
SCHEMA = ("doc_id long, text string, lang string, output string, n long, form string, h1 long, "
          "flush long, local int, groups string, radix int, head string, row long")
MORE = ["a<P>b\nc", "line\n<S", "\n", "\n\n\n", "no break", "two\nlines\n", "<\n<P\n>S>\né\n☃☃",
        "a\x00b\tc\r\n d  <s> </s> <unk> <|endoftext|>", "▁ is a space there", "　 wide  space ",
        " leading and trailing ", "été déjà vu  naïve", "汉字 混排 text 字", "tab\tand nbsp x"]


def odd_rows():
    rows = [(r[0], r[1]) for r in awkward()] + [(100 + i, t) for i, t in enumerate(MORE)]
    return [(i, t, None, "clash", 1, "clash", 2, 3, 4, "clash", 5, "clash", 6) for i, t in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module", params=["odd", "small"])
def docs(request):
    return request.getfixturevalue(request.param)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_fill_in_middle(docs):
    for fim, spm in ((100, 50), (60, 20)):
        out = fill_in_middle.fill_in_middle(docs, fim_percent=fim, spm_percent=spm)
        same([tuple(r) for r in out.collect()],
             [(i, *brute.fill_in_middle(i, t, fim, spm)) for i, t in pairs(docs)])
        back = fill_in_middle.restore(out.withColumn("restored", F.lit("clash")))
        same([(r["doc_id"], r["restored"]) for r in back.collect()],
             [(i, t or "") for i, t in pairs(docs)])


def test_fill_in_middle_of_random_lines():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab\n<>PSMé") for _ in range(rnd.randrange(40)))
             for _ in range(400)]
    draws = [pa.array([rnd.randrange(2**32) for _ in texts]) for _ in range(4)]
    _, form, _, _, output = fill_in_middle.transform(pa.array(texts), draws, 80, 50)
    assert set(form.to_pylist()) == {"plain", "psm", "spm"}
    assert fill_in_middle.restored(form, output).to_pylist() == texts


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(llm_queries.tokenizer_path(llm_queries.BYTES))
    a.encode_special_tokens = True
    own = {i: e for e, i in a.get_vocab().items()}
    letters = token_alignment._byte_letters()
    b = sentencepiece.SentencePieceProcessor(
        model_file=llm_queries.tokenizer_path(llm_queries.PIECES))
    return (lambda t: a.encode(t, add_special_tokens=False).ids,
            lambda i: bytes(letters[c] for c in own[i]),
            b.encode, lambda i: (bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i)
                                 else b.id_to_piece(i).replace("▁", " ").encode()))


def align(df, **more):
    return token_alignment.align(df, llm_queries.tokenizer_path(llm_queries.BYTES),
                                 llm_queries.tokenizer_path(llm_queries.PIECES), **more)


def test_alignment(docs, tokenizers, monkeypatch):
    rows = pairs(docs)
    want, total = brute.alignments([t for _, t in rows], *tokenizers)
    top = {}
    for (b, _), n in total.items():
        top[b] = max(top.get(b, 0), n)
    links = [(b, a, n, n == top[b]) for (b, a), n in total.items()]
    want = [(i, *x) for (i, _), x in zip(rows, want)]
    for slice_bytes in (token_alignment.SLICE_BYTES, 500):
        monkeypatch.setattr(token_alignment, "SLICE_BYTES", slice_bytes)
        got = align(docs)
        same([tuple(r) for r in got.documents.collect()], want)
        same([tuple(r) for r in got.pairs.collect()], links)
    hashed = align(docs, hashed=True).documents.select("doc_id", "groups")
    same([tuple(r) for r in hashed.collect()],
         [(w[0], brute.sha(w[-1]) if w[-1] else "") for w in want])


def test_alignment_in_several_flushes(small, tokenizers):
    """Runs of few links each, and units that are forgotten in between."""
    table = small.select(F.lit(0).alias("row"), "doc_id", "text").toArrow().combine_chunks()
    files = [open(llm_queries.tokenizer_path(n), "rb").read()
             for n in (llm_queries.BYTES, llm_queries.PIECES)]
    aligner = token_alignment.Aligner(*files, cache_units=500)
    texts = [t for t in table["text"].to_pylist() if t and "▁" not in t]
    want, total = brute.alignments(texts, *tokenizers)
    got, heads = [], []
    for a in range(0, len(texts), 20):
        flush = token_alignment._Flush()
        flush.id = a
        some = texts[a:a + 20]
        part = pa.RecordBatch.from_arrays([pa.array(range(len(some)))] * 2 + [pa.array(some)],
                                          names=["row", "doc_id", "text"])
        got += token_alignment._documents(aligner, flush, part, False)["groups"].to_pylist()
        for batch in flush.runs(aligner.a_bits):
            heads += zip(batch["radix"].to_pylist(), batch["head"].to_pylist())
    assert got == [w[-1] for w in want]
    counted = {}
    for r in range(token_alignment.RADIXES):
        runs = [token_alignment.read_head(h)[::2] for x, h in heads if x == r]
        last = -1
        for b, ids, counts in token_alignment.merged(runs, aligner.a_bits):
            assert b > last
            last = b
            counted.update({(b * token_alignment.RADIXES + r, i): n
                            for i, n in zip(ids.tolist(), counts.tolist())})
    assert counted == dict(total)


def test_run_blocks_round_trip():
    rnd = np.random.default_rng(2)
    links = rnd.integers(0, 300, 5000) << 16 | rnd.integers(0, 9, 5000)
    docs = rnd.integers(0, 40, 5000)
    got = {}
    for r, head, body in token_alignment.sorted_runs(links.copy(), docs.copy(), 16):
        pairs_, documents, total = token_alignment.read_head(head)
        doc, times = token_alignment.read_body(body, documents)
        assert np.add.reduceat(times, np.cumsum(documents) - documents).tolist() == total.tolist()
        for p, d, t in zip(np.repeat(pairs_, documents).tolist(), doc.tolist(), times.tolist()):
            got[((p >> 16) * token_alignment.RADIXES + r) << 16 | p & 0xFFFF, d] = t
    names, times = np.unique(np.stack((links, docs)), axis=1, return_counts=True)
    assert got == {(a, d): t for a, d, t in zip(*names.tolist(), times.tolist())}


def test_alignment_of_one_very_long_word(spark):
    df = spark.createDataFrame([(1, "x" * 3_000_000), (2, "\n" * 500_000), (3, " " * 300_000)],
                               "doc_id long, text string")
    out = {r["doc_id"]: r for r in align(df, hashed=True).documents.collect()}
    assert out[1]["n_links"] >= out[1]["n_a"] > 300_000 and out[2]["n_b"] == 500_001
    assert out[3]["n_links"] > 0


def vectors(n, width=16, seed=4):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, width)), 3)
    x[1::7] = np.round(x[0:-1:7][:len(x[1::7])] + rnd.normal(scale=0.05, size=x[1::7].shape), 3)
    return x


def check_nearest(df, rows, least=0.9):
    got = [tuple(r) for r in prefix_forest.nearest_vectors(df).collect()]
    want = brute.nearest(rows)
    assert sorted(r[:2] for r in got) == sorted(r[:2] for r in want)
    hits = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(hits) >= least * len({(q, v) for q, _, v, _ in want})
    return sorted(got, key=key), sorted(want, key=key)


def test_forest_against_brute_force(spark):
    x = vectors(1500)
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got, _ = check_nearest(df, rows)
    for q, _, v, score in got:
        a, b = x[q], x[v]
        assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12


def test_forest_of_many_stretches(spark, monkeypatch):
    """Prefixes that span partitions, in small blocks and chunks."""
    monkeypatch.setattr(prefix_forest, "STRETCH", 700)
    monkeypatch.setattr(prefix_forest, "CHUNK", 64)
    rows = [(i, v) for i, v in enumerate(vectors(1000, seed=8).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    check_nearest(df, rows)


def test_forest_on_awkward_vectors(spark):
    """Copies, ties, scaled vectors, other widths, unusable ones, repeated and absent ids."""
    nan, inf = float("nan"), float("inf")
    base = [[1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [1.0, 2.0, 3.1], [-1.0, 0.0, 0.5], [0.0, 1.0, 0.0]]
    rows = [(i, base[0]) for i in (0, 50, 50, 100, 7, 3, 9, 11, 13)]
    rows += [(150, base[1]), (151, base[2]), (200, base[3]), (None, base[0]), (None, base[4]),
             (250, None), (300, []), (350, [0.0, 0.0, 0.0]), (400, [nan, 1.0, 1.0]),
             (450, [inf, 1.0, 1.0]), (500, [None, 1.0, 1.0]), (550, [1.0, 2.0]), (551, [2.0, 1.0]),
             (600, [5.0])]
    # cosines of these with the first differ from 1 by rounding alone
    huge = [(650, [1e200, 2e200, 3e200]), (700, [1e-300, 2e-300, 3e-300])]
    for more in ([], huge):
        df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows + more],
                                   "vec_id long, embedding array<double>, vector string, h long, "
                                   "cid long, asked int").repartition(3)
        got, want = check_nearest(df, rows + more, least=0 if more else 1)
        assert [(q, r, 0 if more else v, round(s, 9)) for q, r, v, s in got] == [
            (q, r, 0 if more else v, round(s, 9)) for q, r, v, s in want]


def test_forest_where_a_third_is_one_vector(spark):
    x = vectors(900, seed=6).tolist()
    rows = [(i, x[0] if i % 3 == 0 else v) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    check_nearest(df, rows)


def test_ascent_stops_together():
    held = np.zeros((3, prefix_forest.BITS + 1), np.int64)
    held[0, :4] = [40, 20, 9, 2]
    held[1, :2] = [40, 7]
    assert prefix_forest.stops(held, 9).tolist() == [2, 0, 0]
    assert prefix_forest.stops(held, 2).tolist() == [3, 1, 0]
    s = np.array([0b1011 << 60, 0], np.uint64)
    low, high = prefix_forest.stretch(s, np.array([2, 0]))
    assert [int(v) for v in low] == [0b10 << 62, 0]
    assert [int(v) for v in high] == [(0b11 << 62) - 1, 2**64 - 1]
    assert prefix_forest.common_prefix(s[:1], s[:1] ^ np.uint64(1))[0] == 63


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(docs)).collect() == []
    got = align(docs)
    assert got.documents.collect() == [] and got.pairs.collect() == []
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert prefix_forest.nearest_vectors(none).collect() == []
    lone = spark.createDataFrame([(50, [1.0]), (3, None)], "vec_id long, embedding array<float>")
    assert prefix_forest.nearest_vectors(lone).collect() == []
    unasked = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert prefix_forest.nearest_vectors(unasked).collect() == []
