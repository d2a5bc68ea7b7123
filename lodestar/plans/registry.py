"""Registered queries: one Spark plan per operator and its DuckDB oracle SQL.

Every query reads the driver tables through :mod:`lodestar.plans.warehouse`
and runs over whole tables.  The SQL mirrors the same derivations so the
driver can compare results; floating-point vectors are rounded to 6 places in
both for a stable comparison (scores and vectors are exact in the library).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.vectors import round_array
from lodestar.operators import (
    article_clicks, base_profile, content_terms, daily_states, document_frequency,
    document_vectors, finish_states, fold_changes, hashing_tf, keyword_vectors, latest_snapshot, merge_states,
    read_snapshot, read_states, sample_for_dev, save_states, term_frequency, tfidf, tokenize, top_keywords,
    top_terms_table, train_word_vectors, user_embedding,
)
from lodestar.operators.joins import fits_broadcast, vector_broadcast_rows
from lodestar.operators.keywords import DEFAULT_TOP_K
from lodestar.operators.terms import terms_by_article, terms_from_rest
from lodestar.operators.vectors import W2V_SIZE
from lodestar.plans import jobs
from lodestar.plans import warehouse as W
from lodestar.session import ensure_checkpoint_dir
from lodestar.sources.tables import (
    materialize, on_days, read_partitions, replace_partitions, save_counted, save_table,
    stored, write_all,
)

DIGITS = 6
SMALL_VOCAB = 1000      # a second vocabulary query where the cap actually cuts
DEV_SAMPLE_ROWS = 100
SNAPSHOT_BUCKETS = 16
ARTICLE_BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- Spark side

def _content_terms(spark: SparkSession, d: str) -> DataFrame:
    """O3 output, written once to the checkpoint folder (the article-terms table)."""
    stop = materialize(W.stopwords(spark, d))
    dictionary = materialize(W.dictionary(spark, d))
    return stored(content_terms(W.articles(spark, d), stop, dictionary), "article-terms")


def _top(spark: SparkSession, d: str, ct: DataFrame | None = None, order: str = "desc"):
    ct = ct if ct is not None else _content_terms(spark, d)
    return top_keywords(tfidf(ct, unique=True), DEFAULT_TOP_K, order)


def _kw_join(spark: SparkSession, d: str) -> DataFrame:
    """O5 join output."""
    ct = _content_terms(spark, d)
    word_vec = stored(W.word_vectors(spark, d, ct), "word-vectors")   # the word-vector table
    return keyword_vectors(_top(spark, d, ct), word_vec)


def _kw_vec(spark: SparkSession, d: str) -> DataFrame:
    """O5 join output, written once (the keyword-vector table)."""
    return stored(_kw_join(spark, d), "keyword-vectors")


def _clicks(spark: SparkSession, d: str) -> DataFrame:
    events = W.click_events(spark, d, W.CLICK_START, W.CLICK_END)
    return article_clicks(events, W.CLICK_START, W.CLICK_END)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_base_profile(spark, d):
    return base_profile(W.users(spark, d), W.base_info(spark, d), region="from_mobile")


def q_base_profile_given_region(spark, d):
    return base_profile(W.users(spark, d), W.base_info(spark, d), region="given")


def q_tokens(spark, d):
    return tokenize(W.articles(spark, d))


def q_stopwords(spark, d):
    return W.stopwords(spark, d)


def q_dictionary(spark, d):
    return W.dictionary(spark, d)


def q_content_terms(spark, d):
    return _content_terms(spark, d)


def q_content_terms_han(spark, d):
    return content_terms(W.han_articles(spark, d), materialize(W.han_stopwords(spark, d)),
                         materialize(W.han_dictionary(spark, d)), han="lattice")


def q_article_terms(spark, d):
    return terms_by_article(_content_terms(spark, d), as_string=True)


def q_article_terms_split(spark, d):
    return terms_from_rest(q_article_terms(spark, d))


def q_vocabulary(spark, d):
    return document_frequency(term_frequency(_content_terms(spark, d), unique=True))


def q_vocabulary_small(spark, d):
    return document_frequency(term_frequency(_content_terms(spark, d), unique=True), SMALL_VOCAB)


def q_tfidf(spark, d):
    s = tfidf(_content_terms(spark, d), unique=True)
    return s.select("article_id", "term", "tf", "df", F.round("idf", DIGITS).alias("idf"),
                    F.round("score", DIGITS).alias("score"))


def q_tfidf_counts(spark, d):
    stop, dictionary = materialize(W.stopwords(spark, d)), materialize(W.dictionary(spark, d))
    every = content_terms(W.articles(spark, d), stop, dictionary, distinct=False)
    return tfidf(every).select("article_id", "term", "tf", "df",
                               F.round("idf", DIGITS).alias("idf"),
                               F.round("score", DIGITS).alias("score"))


def q_top_keywords(spark, d):
    t = _top(spark, d)
    return t.select("article_id", "rank", "term", F.round("score", DIGITS).alias("score"))


def q_top_keywords_asc(spark, d):
    t = _top(spark, d, order="asc")
    return t.select("article_id", "rank", "term", F.round("score", DIGITS).alias("score"))


def q_article_top_terms(spark, d):
    ct = _content_terms(spark, d)
    return top_terms_table(_top(spark, d, ct), ct, as_string=True)


def q_keyword_vectors(spark, d):
    return _kw_join(spark, d)   # read once: by the caller


def q_document_vectors(spark, d):
    v = document_vectors(_kw_vec(spark, d))
    return v.select("article_id", round_array("vector", DIGITS).alias("vector"))


def q_article_clicks(spark, d):
    return _clicks(spark, d)


def q_user_embedding(spark, d):
    u = user_embedding(_clicks(spark, d), _kw_vec(spark, d), preaggregate=True)
    return u.select("uid", round_array("user_vector", DIGITS).alias("user_vector"))


def q_user_embedding_plain(spark, d):
    u = user_embedding(_clicks(spark, d), _kw_vec(spark, d), preaggregate=False)
    return u.select("uid", round_array("user_vector", DIGITS).alias("user_vector"))


def q_user_embedding_bucketed(spark, d):
    """The plain form over tables stored in buckets of ``article_id``: neither side of
    the join is shuffled."""
    db = _database(spark, "buckets")
    bucket = {"bucket_by": "article_id", "buckets": ARTICLE_BUCKETS}
    save_table(_clicks(spark, d), f"{db}.clicks", "parquet", **bucket)
    ct = _content_terms(spark, d)
    word_vec = stored(W.word_vectors(spark, d, ct), "word-vectors")
    # keywords are dealt to the buckets before they have vectors
    top = _top(spark, d, ct).repartition(ARTICLE_BUCKETS, "article_id")
    # a join with a table too large to be sent deals them by word
    dealt = fits_broadcast(word_vec, vector_broadcast_rows(W2V_SIZE))
    save_table(keyword_vectors(top, word_vec), f"{db}.article_top_terms_w2v", "parquet",
               **bucket, dealt=dealt)
    u = user_embedding(spark.table(f"{db}.clicks"), spark.table(f"{db}.article_top_terms_w2v"),
                       preaggregate=False)
    return u.select("uid", round_array("user_vector", DIGITS).alias("user_vector"))


def q_user_embedding_daily(spark, d):
    """States stored day by day, as daily loads would: the days up to the 15th, then the
    later ones, with the 15th loaded once more; the mean is a merge of what is stored."""
    path, kw_vec = _folder(spark, "states"), _kw_vec(spark, d)
    for start, end in ((W.CLICK_START, W.CLICK_MIDDLE), (W.CLICK_MIDDLE, W.CLICK_END)):
        clicks = article_clicks(W.click_events(spark, d, start, end), start, end, keep_day=True)
        save_states(daily_states(clicks, kw_vec), path)
    states = read_states(spark, path, W.CLICK_START, W.CLICK_END)
    u = finish_states(merge_states(states, "uid"), "uid", "user_vector")
    return u.select("uid", round_array("user_vector", DIGITS).alias("user_vector"))


def _database(spark: SparkSession, name: str) -> str:
    """A new catalog database whose tables lie in the shared checkpoint folder."""
    path = _folder(spark, name)
    database = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    return database


def q_profile_published(spark, d):
    """The base profile in a Parquet and an ORC table, one of which is read back."""
    db = _database(spark, "profile")
    counts = []
    write_all(q_base_profile(spark, d), [
        lambda df: counts.append(save_counted(df, f"{db}.user_profile_base", "parquet")),
        lambda df: counts.append(save_counted(df, f"{db}.user_profile_orc", "orc"))])
    if counts[0] != counts[1]:
        raise RuntimeError(f"the sinks have {counts} rows")
    return spark.table(f"{db}.user_profile_orc")


def q_content_chain(spark, d):
    """Jobs 3 to 6 over catalog tables, term lists at rest as comma strings."""
    db = _database(spark, "chain")
    save_table(W.articles(spark, d), f"{db}.article_cn", "parquet")
    save_table(W.events(spark, d).drop("ts"), f"{db}.event", "parquet")
    jobs.segment_job(spark, f"{db}.article_cn", f"{db}.article_terms",
                     materialize(W.stopwords(spark, d)), materialize(W.dictionary(spark, d)),
                     at_rest=True)
    jobs.keywords_job(spark, f"{db}.article_terms", f"{db}.article_top_terms", at_rest=True)
    vocabulary = terms_from_rest(spark.table(f"{db}.article_terms"))
    jobs.word2vec_job(spark, f"{db}.article_top_terms", f"{db}.article_top_terms_w2v",
                      word_vec=W.word_vectors(spark, d, vocabulary))
    jobs.user_embedding_job(spark, f"{db}.event", f"{db}.article_top_terms_w2v",
                            f"{db}.user_content_embedding", W.CLICK_START, W.CLICK_END)
    u = spark.table(f"{db}.user_content_embedding")
    return u.select("uid", round_array("user_vector", DIGITS).alias("user_vector"))


def q_latest_event(spark, d):
    return latest_snapshot(W.table(spark, d, "events"), "user_id", ["ts", "event_id"])


def q_latest_event_folded(spark, d):
    """The snapshot folded from ten days of events at a time, the middle ones last."""
    events, path = W.table(spark, d, "events"), _folder(spark, "snapshot")
    day = F.dayofmonth("ts")
    for part in (day <= 10, day > 20, (day > 10) & (day <= 20)):
        fold_changes(events.where(part), path, "user_id", ["ts", "event_id"], SNAPSHOT_BUCKETS)
    return read_snapshot(spark, path, events.schema)


def _events_by_day(spark, d):
    """The event table, stored by day."""
    path = _folder(spark, "events")
    events = W.events(spark, d)
    replace_partitions(events, path, "logday")
    return read_partitions(spark, path, events.schema)


def q_article_clicks_by_day(spark, d):
    return article_clicks(_events_by_day(spark, d), W.CLICK_START, W.CLICK_END)


def q_article_clicks_on_days(spark, d):
    """Clicks of the days of a month with more orders than the mean, a list known at run
    time only."""
    orders = W.table(spark, d, "orders").select(
        F.concat(F.lit("202401"), F.date_format("o_orderdate", "dd")).alias("logday"))
    busy = orders.groupBy("logday").agg(F.count(F.lit(1)).alias("n"))
    days = busy.where(F.col("n") > busy.select(F.avg("n")).scalar())
    return article_clicks(on_days(_events_by_day(spark, d), days), W.CLICK_START, W.CLICK_END)


def q_dev_sample(spark, d):
    docs = W.table(spark, d, "documents")
    return sample_for_dev(docs, "doc_id", DEV_SAMPLE_ROWS).select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("text").alias("content"))


def q_hashing_tf(spark, d):
    return hashing_tf(terms_by_article(_content_terms(spark, d)), 512)


def q_word_vectors(spark, d):
    docs = terms_by_article(_content_terms(spark, d))
    # as many training tasks as the cluster runs at a time
    return train_word_vectors(docs, seed=42, partitions=None)


QUERIES: dict[str, Query] = {
    "base_profile": q_base_profile,
    "base_profile_given_region": q_base_profile_given_region,
    "profile_published": q_profile_published,
    "content_chain": q_content_chain,
    "tokens": q_tokens,
    "stopwords": q_stopwords,
    "dictionary": q_dictionary,
    "content_terms": q_content_terms,
    "content_terms_han": q_content_terms_han,
    "article_terms": q_article_terms,
    "article_terms_split": q_article_terms_split,
    "vocabulary": q_vocabulary,
    "vocabulary_small": q_vocabulary_small,
    "tfidf": q_tfidf,
    "tfidf_counts": q_tfidf_counts,
    "top_keywords": q_top_keywords,
    "top_keywords_asc": q_top_keywords_asc,
    "article_top_terms": q_article_top_terms,
    "keyword_vectors": q_keyword_vectors,
    "document_vectors": q_document_vectors,
    "article_clicks": q_article_clicks,
    "user_embedding": q_user_embedding,
    "user_embedding_plain": q_user_embedding_plain,
    "user_embedding_daily": q_user_embedding_daily,
    "user_embedding_bucketed": q_user_embedding_bucketed,
    "latest_event": q_latest_event,
    "latest_event_folded": q_latest_event_folded,
    "article_clicks_by_day": q_article_clicks_by_day,
    "article_clicks_on_days": q_article_clicks_on_days,
    "dev_sample": q_dev_sample,
    "hashing_tf": q_hashing_tf,
    "word_vectors": q_word_vectors,
}


# ---------------------------------------------------------------- DuckDB side

SPLIT = r"[^\p{L}\p{N}]+"


def _tokens_sql(name: str, src: str, id_expr: str, text_col: str, ngrams: bool) -> str:
    """``name(article_id, pos, term)``: distinct terms in first-occurrence order."""
    low = f"lower({text_col})"
    if ngrams:      # Han runs stand apart from letters and digits beside them
        low = f"regexp_replace({low}, '(\\p{{Han}}+)', ' \\1 ', 'g')"
    head = (f"{name}_raw AS (SELECT {id_expr} AS article_id, "
            f"string_split_regex({low}, '{SPLIT}') AS toks FROM {src} "
            f"WHERE {text_col} IS NOT NULL AND {id_expr} IS NOT NULL),\n"
            f"{name}_u0 AS (SELECT article_id, unnest(toks) AS tok, "
            f"generate_subscripts(toks, 1) AS idx FROM {name}_raw),\n")
    if ngrams:
        expand = (
            f"{name}_h AS (SELECT article_id, idx, tok, unnest(range(0, length(tok))) AS o "
            f"FROM {name}_u0 WHERE regexp_matches(tok, '\\p{{Han}}')),\n"
            f"{name}_hn AS (SELECT article_id, idx, tok, o, unnest([2, 3, 4, 5, 6, 7, 8]) AS n FROM {name}_h),\n"
            f"{name}_u AS (SELECT article_id, tok AS term, idx * 134217728 AS k FROM {name}_u0 "
            f"WHERE NOT regexp_matches(tok, '\\p{{Han}}') "
            f"UNION ALL SELECT article_id, substr(tok, o + 1, n) AS term, "
            f"idx * 134217728 + o * 8 + n AS k FROM {name}_hn WHERE o + n <= length(tok)),\n")
    else:
        expand = f"{name}_u AS (SELECT article_id, tok AS term, idx AS k FROM {name}_u0),\n"
    tail = (f"{name}_f AS (SELECT article_id, term, min(k) AS k FROM {name}_u "
            f"WHERE length(term) >= 2 GROUP BY article_id, term),\n"
            f"{name} AS (SELECT article_id, CAST(row_number() OVER "
            f"(PARTITION BY article_id ORDER BY k) - 1 AS INTEGER) AS pos, term FROM {name}_f)")
    return head + expand + tail


ARTICLES = "articles AS (SELECT CAST(doc_id AS VARCHAR) AS article_id, text AS content FROM documents)"

BASE_INFO = """ids AS (SELECT DISTINCT user_id FROM events),
bi AS (SELECT CAST(user_id AS VARCHAR) AS distinct_id,
  CASE WHEN user_id % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
  CAST(18 + user_id % 60 AS VARCHAR) AS age,
  CASE user_id % 5 WHEN 0 THEN '86' || CAST(13800000000 + user_id AS VARCHAR)
    WHEN 1 THEN CAST(15000000000 + user_id AS VARCHAR) WHEN 2 THEN CAST(user_id AS VARCHAR)
    WHEN 3 THEN '' END AS mobile,
  'R' || CAST(user_id % 34 AS VARCHAR) AS region,
  CASE user_id % 6 WHEN 0 THEN 'u' || CAST(user_id AS VARCHAR) || '@example.com'
    WHEN 1 THEN 'u' || CAST(user_id AS VARCHAR) || '@'
    WHEN 2 THEN '@mail' || CAST(user_id AS VARCHAR) || '.org'
    WHEN 3 THEN 'a@b@c' WHEN 4 THEN 'noat' || CAST(user_id AS VARCHAR) END AS email,
  'model-' || CAST(user_id % 7 AS VARCHAR) AS model
FROM ids),
u AS (SELECT CAST(c_custkey AS VARCHAR) AS distinct_id FROM customer)"""

EMAIL_SUFFIX = ("CASE WHEN len(string_split(email, '@')) = 2 "
                "THEN string_split(email, '@')[2] ELSE '' END AS email_suffix")

PLAIN_TOKENS = _tokens_sql("ptok", "articles", "article_id", "content", ngrams=False)
SIDE_TOKENS = _tokens_sql("stok", "conversations",
                          "CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR)", "text",
                          ngrams=False)
STOP = ("stop AS (SELECT term AS word FROM stok GROUP BY term HAVING count(*) * 5 >= "
        "(SELECT count(DISTINCT article_id) FROM stok))")
DICT = (_tokens_sql("btok", "benchmark", "CAST(item_id AS VARCHAR)", "text", ngrams=False) + ",\n"
        "dict_all AS (SELECT DISTINCT term AS word, 'nz' AS pos, 0 AS prio FROM btok "
        "UNION ALL SELECT word, CASE WHEN word LIKE '%ing' OR word LIKE '%ed' THEN 'v' "
        "WHEN word LIKE '%ly' OR word LIKE '%ment' THEN 'd' "
        "WHEN regexp_matches(word, '^[0-9]+$') THEN 'm' ELSE 'n' END, 1 "
        "FROM (SELECT DISTINCT term AS word FROM stok)),\n"
        "dict AS (SELECT word, arg_min(pos, prio) AS pos FROM dict_all GROUP BY word)")
CONTENT = (ARTICLES + ",\n" + SIDE_TOKENS + ",\n" + STOP + ",\n" + DICT + ",\n"
           + _tokens_sql("ctok", "articles", "article_id", "content", ngrams=True) + ",\n"
           "ct AS (SELECT article_id, pos, term FROM ctok "
           "WHERE term NOT IN (SELECT word FROM stop) "
           "AND term IN (SELECT word FROM dict WHERE pos LIKE 'n%'))")


def _vocab_sql(limit: int | None = None) -> str:
    most = f" ORDER BY cnt DESC, term LIMIT {limit}" if limit else ""
    return ("vocab AS (SELECT term, count(*) AS cnt, count(*) AS df FROM ct GROUP BY term"
            f"{most})")


SCORED = (CONTENT + ",\n" + _vocab_sql() + ",\n"
          "ndocs AS (SELECT count(DISTINCT article_id) AS n FROM ct),\n"
          "scored AS (SELECT ct.article_id, ct.term, CAST(1 AS BIGINT) AS tf, v.df, "
          "ln((ndocs.n + 1.0) / (v.df + 1.0)) AS idf, "
          "CAST(1 AS BIGINT) * ln((ndocs.n + 1.0) / (v.df + 1.0)) AS score "
          "FROM ct JOIN vocab v ON ct.term = v.term CROSS JOIN ndocs)")


def _top_sql(order: str) -> str:
    return (SCORED + ",\n"
            "top AS (SELECT article_id, rank, term, score FROM (SELECT article_id, term, score, "
            f"CAST(row_number() OVER (PARTITION BY article_id ORDER BY score {order}, term) "
            f"AS INTEGER) AS rank FROM scored) WHERE rank <= {DEFAULT_TOP_K})")


KW_VEC = (_top_sql("DESC") + ",\n"
          "slots AS (SELECT floor(count(*) * 5 / 4) AS s FROM embeddings),\n"
          "words AS (SELECT term AS word, CAST((ascii(term) * 31 + length(term) * 7 "
          "+ ascii(right(term, 1)) * 131) % (SELECT s FROM slots) AS BIGINT) AS vec_id "
          "FROM (SELECT DISTINCT term FROM ct)),\n"
          "wv AS (SELECT w.word, CAST(e.embedding AS DOUBLE[]) AS vector FROM words w "
          "JOIN embeddings e ON w.vec_id = e.vec_id),\n"
          "kw AS (SELECT t.article_id, t.term AS top_term, wv.vector FROM top t "
          "LEFT JOIN wv ON t.term = wv.word)")

CLICKS = """ev AS (SELECT CAST(user_id AS VARCHAR) AS distinct_id,
  json_extract_string(props, '$.k') AS article_id, strftime(ts, '%Y%m%d') AS logday,
  CASE WHEN event_type = 'click' THEN 'AppClick' ELSE event_type END AS event,
  CASE WHEN value >= 5 THEN '内容详情页' ELSE 'home' END AS element_page FROM events),
clicks AS (SELECT distinct_id AS uid, article_id FROM ev
  WHERE logday BETWEEN '20240105' AND '20240125' AND event = 'AppClick'
  AND element_page = '内容详情页' AND article_id IS NOT NULL AND article_id <> '')"""


def _mean_sql(src: str, key: str, col: str, out: str) -> str:
    return (f"SELECT {key}, list(round(m, {DIGITS}) ORDER BY i) AS {out} FROM ("
            f"SELECT {key}, i, avg(x) AS m FROM (SELECT {key}, unnest({col}) AS x, "
            f"generate_subscripts({col}, 1) AS i FROM {src} WHERE {col} IS NOT NULL) "
            f"GROUP BY {key}, i) GROUP BY {key}")


USER_MEAN = ("WITH " + KW_VEC + ",\n" + CLICKS + ",\n"
             "j AS (SELECT c.uid, k.vector FROM clicks c JOIN kw k ON c.article_id = k.article_id "
             "WHERE k.vector IS NOT NULL)\n" + _mean_sql("j", "uid", "vector", "user_vector"))

LATEST_EVENT = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""

PROFILE = "WITH " + BASE_INFO + """
SELECT u.distinct_id AS uid, gender, age,
  CASE WHEN length(mobile) >= 11 THEN right(mobile, 11) ELSE '' END AS region,
  """ + EMAIL_SUFFIX + """, model
FROM u LEFT JOIN bi ON u.distinct_id = bi.distinct_id"""

ORACLE_SQL: dict[str, str] = {
    "base_profile": PROFILE,
    "profile_published": PROFILE,
    "base_profile_given_region": "WITH " + BASE_INFO + """
SELECT u.distinct_id AS uid, gender, age, region, """ + EMAIL_SUFFIX + """, model
FROM u LEFT JOIN bi ON u.distinct_id = bi.distinct_id""",
    "tokens": "WITH " + ARTICLES + ",\n" + PLAIN_TOKENS + "\nSELECT article_id, pos, term FROM ptok",
    "stopwords": "WITH " + SIDE_TOKENS + ",\n" + STOP + "\nSELECT word FROM stop",
    "dictionary": "WITH " + SIDE_TOKENS + ",\n" + DICT
                  + "\nSELECT word, pos FROM dict",
    "content_terms": "WITH " + CONTENT + "\nSELECT article_id, pos, term FROM ct",
    "article_terms": "WITH " + CONTENT + "\nSELECT article_id, "
                     "string_agg(term, ',' ORDER BY pos) AS content_terms FROM ct GROUP BY article_id",
    "article_terms_split": "WITH " + CONTENT + "\nSELECT article_id, CAST(row_number() OVER ("
                           "PARTITION BY article_id ORDER BY pos) - 1 AS INTEGER) AS pos, term "
                           "FROM ct",
    "vocabulary": "WITH " + CONTENT + ",\n" + _vocab_sql()
                  + "\nSELECT term, cnt, df FROM vocab",
    "vocabulary_small": "WITH " + CONTENT + ",\n" + _vocab_sql(SMALL_VOCAB)
                        + "\nSELECT term, cnt, df FROM vocab",
    "tfidf": "WITH " + SCORED + f"\nSELECT article_id, term, tf, df, round(idf, {DIGITS}) AS idf, "
             f"round(score, {DIGITS}) AS score FROM scored",
    "tfidf_counts": "WITH " + CONTENT + f"""
, every AS (SELECT article_id, term, count(*) AS tf FROM ctok_u
  WHERE length(term) >= 2 AND term NOT IN (SELECT word FROM stop)
  AND term IN (SELECT word FROM dict WHERE pos LIKE 'n%') GROUP BY article_id, term),
v AS (SELECT term, count(*) AS df FROM every GROUP BY term),
x AS (SELECT e.article_id, e.term, e.tf, v.df, ln(((SELECT count(DISTINCT article_id) FROM every)
  + 1.0) / (v.df + 1.0)) AS idf FROM every e JOIN v ON e.term = v.term)
SELECT article_id, term, tf, df, round(idf, {DIGITS}) AS idf, round(tf * idf, {DIGITS}) AS score
FROM x""",
    "top_keywords": "WITH " + _top_sql("DESC")
                    + f"\nSELECT article_id, rank, term, round(score, {DIGITS}) AS score FROM top",
    "top_keywords_asc": "WITH " + _top_sql("ASC")
                        + f"\nSELECT article_id, rank, term, round(score, {DIGITS}) AS score FROM top",
    "article_top_terms": "WITH " + _top_sql("DESC") + """
SELECT t.article_id, t.top_terms, a.terms FROM
 (SELECT article_id, string_agg(term, ',' ORDER BY rank) AS top_terms FROM top GROUP BY article_id) t
 JOIN (SELECT article_id, string_agg(term, ',' ORDER BY pos) AS terms FROM ct GROUP BY article_id) a
 ON t.article_id = a.article_id""",
    "keyword_vectors": "WITH " + KW_VEC + "\nSELECT article_id, top_term, vector FROM kw",
    "document_vectors": "WITH " + KW_VEC + "\n" + _mean_sql("kw", "article_id", "vector", "vector"),
    "article_clicks": "WITH " + CLICKS + "\nSELECT uid, article_id FROM clicks",
    "user_embedding": USER_MEAN,
    "user_embedding_plain": USER_MEAN,
    "content_chain": USER_MEAN,
    "user_embedding_daily": USER_MEAN,
    "user_embedding_bucketed": USER_MEAN,
    "article_clicks_by_day": "WITH " + CLICKS + "\nSELECT uid, article_id FROM clicks",
    "article_clicks_on_days": "WITH busy AS (SELECT '202401' || strftime(o_orderdate, '%d') AS logday, "
        "count(*) AS n FROM orders GROUP BY 1),\n" + CLICKS.replace(
        "SELECT distinct_id AS uid, article_id FROM ev", "SELECT distinct_id AS uid, article_id "
        "FROM ev SEMI JOIN (SELECT logday FROM busy WHERE n > (SELECT avg(n) FROM busy)) "
        "USING (logday)") + "\nSELECT uid, article_id FROM clicks",
    "latest_event": LATEST_EVENT,
    "latest_event_folded": LATEST_EVENT,
    "dev_sample": f"SELECT CAST(doc_id AS VARCHAR) AS article_id, text AS content FROM documents "
                  f"ORDER BY doc_id LIMIT {DEV_SAMPLE_ROWS}",
}
