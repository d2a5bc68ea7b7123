"""The pipeline's stages, each against a brute-force version on its own input."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
import regex  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact", "near", "secrets", "pack"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER).cache()
        before = {r["doc_id"]: r for r in docs.collect()}
        after = out.collect()
        if name == "pack":
            assert {r["doc_id"] for r in after} == set(before)
            break
        assert out.columns == columns
        kept = {r["doc_id"]: r for r in after}
        assert len(kept) == len(after)
        if name == "language":
            want = {i for i, r in before.items() if regex.search(r"\p{L}", r["text"] or "")}
            assert set(kept) == want
        elif name == "exact":
            last = {}
            for i, r in before.items():
                last[r["text"] or ""] = max(i, last.get(r["text"] or "", i))
            assert set(kept) == set(last.values())
        elif name == "near":
            rows = [(i, r["text"]) for i, r in before.items()]
            assert set(kept) == {c for _, c in brute.near(rows)}
        elif name == "secrets":
            assert set(kept) == set(before)
            for i, r in kept.items():
                if brute.base_spans(before[i]["text"]):
                    assert "[SECRET]" in r["text"] and r["n_chars"] == len(r["text"])
                else:
                    assert r["text"] == before[i]["text"]
        docs = out


def test_run(spark, tmp_path):
    """``run`` is its stages one after the other, on awkward rows and on none."""
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    base = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", "12 34", base, base, base.replace("w30 ", "other "), "password = hunter22x",
             "alone", "long " * 5000, "long " * 5000]
    rows = [(n if n != 7 else None, t, "en", "s", None if t is None else len(t))
            for n, t in enumerate(texts)]
    for name, some in (("rows", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(some, schema).write.parquet(str(folder / "documents.parquet"))
        got = corpus_pipeline.run(spark, str(folder)).collect()
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, str(folder)).collect(), schema)
        assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()}
        assert {r["doc_id"] for r in got} == ({4, 6, None, 9} if some else set())
        ends = {}
        for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == ends.get(r["sequence_id"], 0) and r["length"] <= 2048
            ends[r["sequence_id"]] = r["offset"] + r["length"]


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert sum(k.startswith("op") and k[2].isdigit() for k in entry.queries()) == 13
