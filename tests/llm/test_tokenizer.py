"""Ids of whole texts are the tokenizer's own, however the texts are cut into units."""

import numpy as np
import pyarrow as pa
import tokenizers

from lodestar.llm.packing import WordTokenizer
from lodestar.llm.queries import WORDS, tokenizer_path

ODD = ["", None, "a'b don't <|x|> <| foo<", "| bar", "Ünï cödé x9y99__z", "A1B2\x00c\x1fd   e",
       "  ", " x y　z", "<|endoftext|>Hi THERE's 12.5%", "x" * 3000 + " 1" * 3000]


def test_ids_equal_the_tokenizer():
    path = tokenizer_path(WORDS)
    plain = tokenizers.Tokenizer.from_file(path)
    for cache in (3, 200_000):
        coder = WordTokenizer(path, cache_units=cache)
        for rows in (ODD, ODD[::-1], ODD[:1], []):
            ids, bounds = coder.encode(pa.array(rows, pa.string()), 0)
            want = [plain.encode(x or "", add_special_tokens=False).ids + [0] for x in rows]
            assert np.diff(bounds).tolist() == [len(x) for x in want]
            assert ids.tolist() == [i for x in want for i in x]
