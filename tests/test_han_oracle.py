"""The Han n-gram branch of tokenisation agrees between Spark and the oracle SQL."""

import duckdb
import pandas as pd

from lodestar.operators.terms import DEFAULT_HAN_NGRAMS
from lodestar.operators import tokenize
from lodestar.plans.registry import _tokens_sql

DOCS = [
    ("d1", "我们今天讨论经济发展和人工智能技术。经济很好！"),
    ("d2", "Market 市场 report, 中文x1 经济学家说：经济"),
    ("d3", "单"),
    ("d4", "plain words only words"),
]


def test_han_tokens_match_sql(spark):
    df = spark.createDataFrame(DOCS, "article_id string, content string")
    got = sorted((r.article_id, r.pos, r.term) for r in
                 tokenize(df, han_ngrams=DEFAULT_HAN_NGRAMS).collect())
    con = duckdb.connect()
    con.register("docs_pd", pd.DataFrame(DOCS, columns=["article_id", "content"]))
    sql = "WITH " + _tokens_sql("t", "docs_pd", "article_id", "content", ngrams=True) + \
          "\nSELECT article_id, pos, term FROM t"
    want = sorted(tuple(r) for r in con.execute(sql).fetchall())
    assert got == want
    assert ("d1", 0, "我们") in got and any(t == "人工智能" for _, _, t in got)
