"""Logical job inputs derived from the driver tables.

The jobs expect warehouse tables (users, base info, articles, click events,
stop words, a part-of-speech dictionary, word vectors).  The driver ships
TPC-H-like tables instead; every input below is derived from them by Spark,
so its size grows with the scale factor.  ``registry.py`` mirrors each
derivation in DuckDB SQL for the oracle check.

Derivations (stand-ins, not reference data):

* users      = ``customer``: ``distinct_id = c_custkey``.
* base_info  = one row per ``events.user_id``; attributes follow from the id
  so that every phone / e-mail edge case occurs.  Most customers have no row.
* articles   = ``documents``: ``article_id = doc_id``, ``content = text``.
* events     = ``events``: ``logday = yyyyMMdd(ts)``, ``article_id = props.k``,
  ``event`` = ``AppClick`` for clicks, ``element_page`` = detail page when
  ``value >= 5``.
* stop words = terms present in at least a fifth of the ``conversations``
  turns (a side corpus, as a stop list is a resource outside the articles).
* dictionary = custom list (terms of ``benchmark``, tag ``nz``) ahead of a
  core list (terms of ``conversations``, tag from the word's ending).
* word_vec   = each corpus term gets row ``f(term) mod ⌊1.25·|embeddings|⌋``
  of ``embeddings``; terms landing past the last row have no vector.
* Han text   = the same articles, stop words and dictionary with each letter
  a-z mapped to a Han character and spaces left out, so that sentences become
  unspaced runs; word frequencies = benchmark items or turns with the word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators.embedding import CLICK_EVENT, DETAIL_PAGE
from lodestar.operators.joins import bounded_broadcast
from lodestar.operators.terms import build_dictionary, tokenize
from lodestar.sources.tables import spread

# Fixed values of the stand-in mapping.
STOPWORD_DF_FRACTION_DENOMINATOR = 5     # stop word: df * 5 >= number of turns
DETAIL_PAGE_MIN_VALUE = 5.0              # events.value >= 5 -> content detail page
OTHER_PAGE = "home"
CUSTOM_POS = "nz"
WORD_SLOT_NUMERATOR, WORD_SLOT_DENOMINATOR = 5, 4   # slots = 1.25 x embedding rows
CLICK_START, CLICK_MIDDLE, CLICK_END = "20240105", "20240115", "20240125"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN_LETTERS = "天地人日月山水火木金土石田禾竹米虫鱼鸟马牛羊犬豕鹿龙"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("distinct_id"))


def base_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select("user_id").distinct()
    uid = F.col("user_id")
    sid = uid.cast("string")
    mobile = (F.when(uid % 5 == 0, F.concat(F.lit("86"), (F.lit(13800000000) + uid).cast("string")))
              .when(uid % 5 == 1, (F.lit(15000000000) + uid).cast("string"))
              .when(uid % 5 == 2, sid)
              .when(uid % 5 == 3, F.lit("")))
    email = (F.when(uid % 6 == 0, F.concat(F.lit("u"), sid, F.lit("@example.com")))
             .when(uid % 6 == 1, F.concat(F.lit("u"), sid, F.lit("@")))
             .when(uid % 6 == 2, F.concat(F.lit("@mail"), sid, F.lit(".org")))
             .when(uid % 6 == 3, F.lit("a@b@c"))
             .when(uid % 6 == 4, F.concat(F.lit("noat"), sid)))
    return ids.select(
        sid.alias("distinct_id"),
        F.when(uid % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("gender"),
        (F.lit(18) + uid % 60).cast("string").alias("age"),
        mobile.alias("mobile"),
        F.concat(F.lit("R"), (uid % 34).cast("string")).alias("region"),
        email.alias("email"),
        F.concat(F.lit("model-"), (uid % 7).cast("string")).alias("model"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("text").alias("content"))
    # Round-robin: even a repeated id cannot pile rows into one task.
    return spread(docs)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_events(table(spark, sf_dir, "events"))


def click_events(spark: SparkSession, sf_dir: str, start: str, end: str) -> DataFrame:
    """:func:`events` that can be detail-page clicks of the days ``start`` to ``end``.

    The day, event and page of the stand-in are computed columns, whose filters
    stop above the scan; stated on the raw columns they are pushed into it.
    """
    first = F.to_timestamp(F.lit(start), "yyyyMMdd")
    after = F.date_add(F.to_date(F.lit(end), "yyyyMMdd"), 1).cast("timestamp")
    raw = table(spark, sf_dir, "events")
    kind = dict(raw.dtypes)["ts"]
    return _as_events(raw.where(
        (F.col("event_type") == "click") & (F.col("value") >= DETAIL_PAGE_MIN_VALUE)
        & (F.col("ts") >= first.cast(kind)) & (F.col("ts") < after.cast(kind))))


def _as_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("distinct_id"),
        F.get_json_object("props", "$.k").alias("article_id"),
        F.date_format("ts", "yyyyMMdd").alias("logday"),
        F.when(F.col("event_type") == "click", F.lit(CLICK_EVENT))
        .otherwise(F.col("event_type")).alias("event"),
        F.when(F.col("value") >= DETAIL_PAGE_MIN_VALUE, F.lit(DETAIL_PAGE))
        .otherwise(F.lit(OTHER_PAGE)).alias("element_page"),
        F.col("ts"),
    )


def side_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain tokens of every conversation turn (id ``conv_id/turn``)."""
    conv = table(spark, sf_dir, "conversations")
    conv = conv.select(F.concat_ws("/", F.col("conv_id").cast("string"),
                                   F.col("turn").cast("string")).alias("turn_id"), "text")
    return tokenize(conv, "turn_id", "text")


def stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms in at least a fifth of the conversation turns (bounded: at most
    5x the mean number of distinct terms per turn)."""
    tok = side_tokens(spark, sf_dir)
    n_docs = tok.select(F.count_distinct("article_id")).scalar()
    df = tok.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return (df.where(F.col("df") * STOPWORD_DF_FRACTION_DENOMINATOR >= n_docs)
            .select(F.col("term").alias("word")))


def pos_by_ending(term) -> F.Column:
    """Stand-in part of speech: verbs end in -ing/-ed, adverbs in -ly/-ment,
    numbers are all digits, the rest are nouns."""
    return (F.when(term.like("%ing") | term.like("%ed"), F.lit("v"))
            .when(term.like("%ly") | term.like("%ment"), F.lit("d"))
            .when(term.rlike("^[0-9]+$"), F.lit("m"))
            .otherwise(F.lit("n")))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    custom = tokenize(table(spark, sf_dir, "benchmark"), "item_id", "text") \
        .select(F.col("term").alias("word")).distinct()
    core = side_tokens(spark, sf_dir).select(F.col("term").alias("word")).distinct() \
        .withColumn("pos", pos_by_ending(F.col("word")))
    return build_dictionary([(custom, CUSTOM_POS), (core, None)])


def to_han(text) -> F.Column:
    """Lower-case text with letters as Han characters and without spaces."""
    return F.translate(F.lower(text), LETTERS + " ", HAN_LETTERS)


def han_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).withColumn("content", to_han(F.col("content")))


def han_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stopwords(spark, sf_dir).select(to_han(F.col("word")).alias("word"))


def han_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word, pos, freq)``: :func:`dictionary` in Han characters, with frequencies."""
    def counted(tokens: DataFrame) -> DataFrame:
        return tokens.groupBy(F.col("term").alias("word")).agg(F.count(F.lit(1)).alias("freq"))

    custom = counted(tokenize(table(spark, sf_dir, "benchmark"), "item_id", "text"))
    core = counted(side_tokens(spark, sf_dir)).withColumn("pos", pos_by_ending(F.col("word")))
    return build_dictionary([(custom, CUSTOM_POS), (core, None)]).withColumn(
        "word", to_han(F.col("word")))


def word_vectors(spark: SparkSession, sf_dir: str, vocabulary: DataFrame) -> DataFrame:
    """``(word, vector array<double>)`` for the words of ``vocabulary(term)``."""
    emb = table(spark, sf_dir, "embeddings")
    slots = emb.select(F.floor(F.count(F.lit(1)) * WORD_SLOT_NUMERATOR
                               / WORD_SLOT_DENOMINATOR)).scalar()
    w = F.col("term")
    slot = F.pmod(F.ascii(w) * 31 + F.length(w) * 7 + F.ascii(F.right(w, F.lit(1))) * 131, slots)
    words = vocabulary.select("term").distinct().select(w.alias("word"), slot.alias("vec_id"))
    vecs = bounded_broadcast(emb.select("vec_id", F.col("embedding").cast("array<double>")
                                        .alias("vector")))
    return words.join(vecs, "vec_id").select("word", "vector")
