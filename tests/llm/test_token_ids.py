"""The stored form of token ids."""

import random

import numpy as np
import pyarrow as pa

from lodestar.llm import packing
from lodestar.llm.queries import WORDS, tokenizer_path


def test_ids_are_written_shorter_than_they_are(spark):
    rnd = random.Random(4)
    words = ["the", "of", "water", "house", "little", "garden", "window", "because"]
    docs = spark.createDataFrame(
        [(i, " ".join(rnd.choice(words) for _ in range(3000))) for i in range(6)] + [(9, None)],
        "doc_id long, text string")
    rows = packing.token_pieces(docs, tokenizer_path(WORDS), with_ids=True).collect()
    assert sum(len(r["ids"]) for r in rows) < sum(r["length"] for r in rows)
    bare = packing.WordTokenizer(tokenizer_path(WORDS))
    for i, text in docs.collect():
        ids, _ = bare.encode(pa.array([text or ""]), packing.END_ID)
        got = [packing.unpacked_ids(r["ids"], r["length"]) for r in
               sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])]
        assert np.concatenate(got).tolist() == ids.tolist()


def test_ids_that_do_not_shrink():
    for kind in ("<u2", "<u4"):
        for ids in (np.array([7], kind), np.arange(5, dtype=kind),
                    np.random.default_rng(1).integers(0, 60_000, 2048).astype(kind)):
            assert packing.unpacked_ids(packing.packed_ids(ids), len(ids)).tolist() == ids.tolist()
            assert len(packing.packed_ids(ids)) <= ids.nbytes + 1
