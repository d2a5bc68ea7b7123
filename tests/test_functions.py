
from lodestar.functions import email_domain, phone_tail, split_terms, terms_to_string


def test_phone_tail_edges(spark):
    rows = [("8615686823255", "15686823255"), ("13812345678", "13812345678"),
            ("123", ""), ("", ""), (None, "")]
    df = spark.createDataFrame(rows, "mobile string, want string")
    got = df.select(phone_tail("mobile").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_email_domain_edges(spark):
    rows = [("a@b.com", "b.com"), ("a@", ""), ("@b", "b"), ("a@b@c", ""),
            ("noat", ""), (None, "")]
    df = spark.createDataFrame(rows, "email string, want string")
    got = df.select(email_domain("email").alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_split_terms_distinct_first_position_and_min_len(spark):
    df = spark.createDataFrame([("Apple, a zeta! APPLE mid-zeta x 42",)], "t string")
    got = df.select(split_terms("t").alias("a")).first().a
    assert got == ["apple", "zeta", "mid", "42"]
    kept_all = df.select(split_terms("t", distinct=False).alias("a")).first().a
    assert kept_all == ["apple", "zeta", "apple", "mid", "zeta", "42"]


def test_split_terms_han_ngrams(spark):
    df = spark.createDataFrame([("经济发展",)], "t string")
    got = df.select(split_terms("t", han_ngrams=(2, 3, 4)).alias("a")).first().a
    # candidates by start offset, then length
    assert got == ["经济", "经济发", "经济发展", "济发", "济发展", "发展"]


def test_terms_to_string(spark):
    df = spark.createDataFrame([(["a", "b"],)], "x array<string>")
    assert df.select(terms_to_string("x").alias("s")).first().s == "a,b"
