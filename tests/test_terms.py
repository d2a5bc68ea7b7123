from lodestar.operators import (
    build_dictionary, content_terms, drop_stopwords, keep_pos, terms_by_article, tokenize,
)
from lodestar.operators.terms import han_lengths


def test_tokenize_drops_null_and_orders(spark):
    docs = spark.createDataFrame([(1, "Beta alpha beta"), (2, None), (None, "x y"), (3, "a b")],
                                 "article_id long, content string")
    rows = sorted((r.article_id, r.pos, r.term) for r in tokenize(docs).collect())
    assert rows == [("1", 0, "beta"), ("1", 1, "alpha")]


def test_content_terms_stopwords_dictionary(spark):
    docs = spark.createDataFrame([
        ("a1", "The market report: market growth, the report of growth"),
        ("a2", "the of and"),           # only stop words -> dropped
        ("a3", "x y z"),                # only one-character words -> dropped
        ("a4", ""),                     # empty -> dropped
        ("a5", None),                   # NULL -> dropped
    ], "article_id string, content string")
    stop = spark.createDataFrame([("the",), ("of",), ("and",)], "word string")
    dictionary = spark.createDataFrame([("market", "n"), ("report", "nz"), ("growth", "vn")],
                                       "word string, pos string")
    ct = content_terms(docs, stop, dictionary)
    rows = sorted((r.article_id, r.pos, r.term) for r in ct.collect())
    assert rows == [("a1", 1, "market"), ("a1", 2, "report")]
    # without a dictionary, every non-stop term of length >= 2 is kept
    ct2 = content_terms(docs, stop)
    assert sorted(r.term for r in ct2.collect()) == ["growth", "market", "report"]
    joined = terms_by_article(ct, as_string=True).collect()
    assert [(r.article_id, r.content_terms) for r in joined] == [("a1", "market,report")]


def test_chinese_article_with_dictionary(spark):
    docs = spark.createDataFrame([("c1", "我们今天讨论经济发展和人工智能技术。经济很好")],
                                 "article_id string, content string")
    dictionary = spark.createDataFrame(
        [("经济", "n"), ("发展", "vn"), ("人工智能", "n"), ("技术", "n"), ("今天", "t"),
         ("我们", "r"), ("讨论", "v")], "word string, pos string")
    stop = spark.createDataFrame([("我们",)], "word string")
    ct = content_terms(docs, stop, dictionary)
    got = terms_by_article(ct).first().terms
    assert got == ["经济", "人工智能", "技术"]


def test_drop_stopwords_and_keep_pos_semantics(spark):
    terms = spark.createDataFrame([("a", 0, "cat"), ("a", 1, "run"), ("a", 2, "the")],
                                  "article_id string, pos int, term string")
    stop = spark.createDataFrame([("the",), ("the",)], "word string")
    assert sorted(r.term for r in drop_stopwords(terms, stop).collect()) == ["cat", "run"]
    dictionary = spark.createDataFrame([("cat", "n"), ("cat", "n"), ("run", "v")],
                                       "word string, pos string")
    assert [r.term for r in keep_pos(terms, dictionary).collect()] == ["cat"]


def test_build_dictionary_priority(spark):
    custom = spark.createDataFrame([("apple", None), ("pear", "nr")], "word string, pos string")
    core = spark.createDataFrame([("apple", "v"), ("plum", "n"), ("pear", "v")],
                                 "word string, pos string")
    extra = spark.createDataFrame([("fig",), ("plum",)], "word string")
    d = {r.word: r.pos for r in build_dictionary([(custom, "nz"), (core, None),
                                                   (extra, "ns")]).collect()}
    assert d == {"apple": "nz", "pear": "nr", "plum": "n", "fig": "ns"}


def test_terms_from_rest(spark):
    from lodestar.operators.terms import terms_from_rest
    df = spark.createDataFrame([("a", "x,,y"), ("b", None)], "article_id string, content_terms string")
    assert [tuple(r) for r in terms_from_rest(df).collect()] == [("a", 0, "x"), ("a", 1, "y")]


def test_mixed_han_and_latin_words_are_kept_apart(spark):
    from lodestar.functions.strings import split_terms
    df = spark.createDataFrame([("新款iPhone手机 呼和浩特市",)], "t string")
    got = df.select(split_terms("t", han_ngrams=(2, 3, 4, 5)).alias("a")).first().a
    assert {"iphone", "新款", "手机", "呼和浩特市"} <= set(got)


def test_dictionary_words_of_any_length_are_found(spark):
    long = "新疆维吾尔自治区克孜勒苏柯尔克孜自治州人民政府"       # 23 characters
    words = [long, "中华人民共和国国务院", "呼和浩特市", "会议", "人民"]
    other = "讨论人民政府工作报告的会议纪要"                      # a verb: its length is not made
    dictionary = spark.createDataFrame([(w, "nt") for w in words] + [(other, "v"), ("x" * 40, "n")],
                                       "word string, pos string")
    texts = {"a": f"昨天{long}召开会议，会议在呼和浩特市", "b": "中华人民共和国国务院2024年会议",
             "c": long, "d": "plain words"}
    docs = spark.createDataFrame(list(texts.items()), "article_id string, content string")
    want = {(i, w) for i, t in texts.items() for w in words if w in t}
    got = [(r.article_id, r.term) for r in content_terms(docs, None, dictionary).collect()]
    assert sorted(got) == sorted(want)
    assert han_lengths(dictionary) == (2, 3, 4, 5, 6, 7, 8, 10, 23)
    order = {r.article_id: r.terms for r in
             terms_by_article(content_terms(docs, None, dictionary)).collect()}
    assert order["a"] == [long, "人民", "会议", "呼和浩特市"]


def test_untagged_words_keep_their_priority_and_frequencies_win_with_their_list(spark):
    first = spark.createDataFrame([("apple", None, 7), ("pear", "n", None), ("fig", "v", 2),
                                   ("fig", "n", 9)], "word string, pos string, freq long")
    second = spark.createDataFrame([("apple", "n"), ("pear", "v"), ("plum", "n")],
                                   "word string, pos string")
    rows = build_dictionary([(first, None), (second, None)]).collect()
    assert {tuple(r) for r in rows} == {("apple", None, 7), ("pear", "n", None), ("fig", "n", 9),
                                        ("plum", "n", None)}
    assert build_dictionary([(second, None)]).columns == ["word", "pos"]


def test_stop_words_leave_the_word_list(spark):
    docs = spark.createDataFrame([("a", "pony apple run pony"), ("b", "apple"), ("c", "pear run")],
                                 "article_id string, content string")
    stop = spark.createDataFrame([("apple",), ("apple",), (None,), ("other",)], "word string")
    words = spark.createDataFrame([("apple", "n"), ("pony", "nz"), ("pear", "n"), ("pear", "n"), ("run", "v"),
                                   (None, "n")], "word string, pos string")
    terms = content_terms(docs, stop, words)
    plan = terms._jdf.queryExecution().optimizedPlan().toString()
    # one look at each term of a text; the stop words meet the word list only
    assert plan.index("LeftSemi") < plan.index("Generate") < plan.index("LeftAnti")
    assert sorted(map(tuple, terms.collect())) == [("a", 0, "pony"), ("c", 0, "pear")]
