"""Property checks: Spark column functions against plain-Python statements of
the same rules, and user-vector invariants, each on one batched frame."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.functions import email_domain, phone_tail
from lodestar.operators import user_embedding


def py_phone_tail(m, n=11):
    return m[-n:] if m is not None and len(m) >= n else ""


def py_email_domain(e):
    if e is None:
        return ""
    parts = e.split("@")
    return parts[1] if len(parts) == 2 else ""


text = st.one_of(st.none(), st.text(alphabet="0123456789@.ab中+", max_size=16))


@settings(max_examples=5, deadline=None)
@given(st.lists(text, min_size=1, max_size=200))
def test_phone_and_email_rules(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(phone_tail("v").alias("p"), email_domain("v").alias("e")).collect()
    assert [(r.p, r.e) for r in got] == [(py_phone_tail(v), py_email_domain(v)) for v in values]


def test_user_vector_within_input_range(spark):
    rnd = random.Random(5)
    kw = [(f"a{a}", f"t{t}", [rnd.uniform(-3, 3) for _ in range(4)])
          for a in range(20) for t in range(rnd.randint(1, 6))]
    clicks = [(f"u{rnd.randint(0, 9)}", f"a{rnd.randint(0, 24)}") for _ in range(300)]
    kdf = spark.createDataFrame(kw, "article_id string, top_term string, vector array<double>")
    cdf = spark.createDataFrame(clicks, "uid string, article_id string")
    by_article = {}
    for a, _, v in kw:
        by_article.setdefault(a, []).append(v)
    for mode in (True, False):
        got = {r.uid: r.user_vector for r in user_embedding(cdf, kdf, preaggregate=mode).collect()}
        for uid, vec in got.items():
            inputs = [v for u, a in clicks if u == uid for v in by_article.get(a, [])]
            assert inputs
            for i, x in enumerate(vec):
                comp = [v[i] for v in inputs]
                assert min(comp) - 1e-9 <= x <= max(comp) + 1e-9
                assert abs(x - sum(comp) / len(comp)) < 1e-9
