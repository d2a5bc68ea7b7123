"""O4 — TF-IDF keywords per article (A3–A5, K1, K2, M2, M3, M6).

Long form ``(article_id, term, tf, df, score)`` instead of a 262,144-wide
sparse vector: the vocabulary never sits on the driver, and scores are paired
with their own term by a keyed join (never by position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.strings import terms_to_string
from lodestar.operators.joins import bounded_broadcast
from lodestar.operators.ranking import global_top_n
from lodestar.sources.tables import stored

# The source system's vocabulary cap 512 * 512 (not applied unless asked for) and minimum document frequency 1,
# top-K 30 keywords per article.
DEFAULT_VOCAB_SIZE = 512 * 512
DEFAULT_MIN_DF = 1
DEFAULT_TOP_K = 30


def term_frequency(terms: DataFrame, unique: bool = False) -> DataFrame:
    """A5: ``(article_id, term, tf)``, one row for each term of an article.

    ``unique=True`` states that the input already holds each (article, term)
    once, so ``tf`` is 1 and no shuffle is spent on it.
    """
    if unique:
        return terms.select("article_id", "term", F.lit(1).cast("long").alias("tf"))
    return terms.groupBy("article_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_count(terms: DataFrame) -> Column:
    """Number of documents, as a lazy scalar subquery (one value, no cross join)."""
    return terms.select(F.count_distinct("article_id")).scalar()


def document_frequency(tf: DataFrame, vocab_size: int | None = None,
                       min_df: float = DEFAULT_MIN_DF, n_docs: Column | None = None) -> DataFrame:
    """A3/K2: vocabulary ``(term, cnt, df)``.

    ``cnt`` = corpus term count, ``df`` = documents containing the term.  Terms
    below ``min_df`` (a count, or a fraction of documents when < 1) are dropped,
    then, if a ``vocab_size`` is given, that many most frequent terms are kept
    (ties by term); by default every term is, the rare ones of high IDF too.  Both
    sums aggregate partially on the map side, so a term present in every
    document costs one row per partition before the shuffle.
    """
    vocab = tf.groupBy("term").agg(F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df"))
    if min_df >= 1:
        vocab = vocab.where(F.col("df") >= F.lit(int(min_df)))
    else:
        if n_docs is None:
            raise ValueError("a fractional min_df needs n_docs")
        vocab = vocab.where(F.col("df") >= F.lit(min_df) * n_docs)
    if vocab_size is not None:
        vocab = global_top_n(vocab, "cnt", "term", vocab_size)
    return vocab


def tfidf(terms: DataFrame, vocab_size: int | None = None,
          min_df: float = DEFAULT_MIN_DF, unique: bool = False) -> DataFrame:
    """``(article_id, term, tf, df, idf, score)`` with ``idf = ln((N+1)/(df+1))``.

    ``N`` counts every article of the input, including those whose terms all
    fall outside the vocabulary (as a count-vectorised corpus does).  Repeated
    (article, term) rows count as occurrences of one term, so ``df`` never
    exceeds ``N``; ``unique=True`` states that there are none and spares a
    shuffle.  Counted terms and the vocabulary are written once to the checkpoint
    folder, since each is read again.  The vocabulary is broadcast if its measured
    bytes allow it, so that the rows of terms are not shuffled; a larger one joins
    on ``term``, where AQE splits hot terms.
    """
    tf = term_frequency(terms, unique)
    if not unique:
        tf = stored(tf, "term-frequency")
    n_docs = document_count(tf)
    idf = F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))
    vocab = bounded_broadcast(stored(
        document_frequency(tf, vocab_size, min_df, n_docs).select("term", "df", idf.alias("idf")),
        "vocabulary"))
    return (tf.join(vocab, "term")
            .select("article_id", "term", "tf", "df", "idf")
            .withColumn("score", F.col("tf") * F.col("idf")))


def top_keywords(scored: DataFrame, k: int = DEFAULT_TOP_K, order: str = "desc") -> DataFrame:
    """K1: ``(article_id, rank, term, score)``, at most ``k`` rows per article.

    ``order="desc"`` keeps the highest TF-IDF terms (keyword extraction);
    ``order="asc"`` keeps the lowest.  Ties break on the term.  The
    ``row_number() <= k`` filter lets Spark insert a per-partition group limit
    before the shuffle on ``article_id``.
    """
    if order not in ("desc", "asc"):
        raise ValueError("order must be 'desc' or 'asc'")
    score = F.col("score").desc() if order == "desc" else F.col("score").asc()
    w = Window.partitionBy("article_id").orderBy(score, F.col("term").asc())
    return (scored.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("article_id", "rank", "term", "score"))


def top_terms_table(top: DataFrame, terms: DataFrame, as_string: bool = True) -> DataFrame:
    """At-rest form ``(article_id, top_terms, terms)``: keywords in rank order,
    all terms in text order; comma strings when ``as_string``.  ``terms`` is in long form, or
    at rest: then its lists are grouped as they are, not term by term.
    """
    tops = top.groupBy("article_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                    lambda s: s["term"]).alias("top_terms"))
    if "content_terms" in terms.columns:
        alls = _lists_from_rest(terms)
    else:
        alls = terms.groupBy("article_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))),
                        lambda s: s["term"]).alias("terms"))
    out = tops.join(alls, "article_id")
    if as_string:
        out = out.select("article_id", terms_to_string("top_terms").alias("top_terms"),
                         terms_to_string("terms").alias("terms"))
    return out


def _lists_from_rest(table: DataFrame, sep: str = ",") -> DataFrame:
    """``(article_id, terms)``: the terms of all lists of an article, by their places in them."""
    def placed(terms: Column) -> Column:
        if dict(table.dtypes)["content_terms"] == "string":
            terms = F.split(terms, sep)
        return F.transform(F.filter(terms, lambda t: F.length(t) > 0),
                           lambda t, i: F.struct(i.alias("pos"), t.alias("term")))

    lists = table.groupBy("article_id").agg(F.collect_list("content_terms").alias("lists"))
    every = F.array_sort(F.flatten(F.transform("lists", placed)))
    return lists.select("article_id", F.transform(every, lambda s: s["term"]).alias("terms")) \
        .where(F.size("terms") > 0)


def hashing_tf(docs: DataFrame, num_features: int = 512, terms_col: str = "terms") -> DataFrame:
    """M6: hashed term frequencies ``(article_id, bucket, tf)`` from article term arrays.

    Uses MLlib's ``HashingTF`` itself (JVM-side): its Murmur3 variant differs
    from SQL ``hash()`` for strings whose UTF-8 length is not a multiple of 4,
    so ``pmod(hash(term), n)`` would not give the same buckets.  Only the
    vector's set entries are expanded, so any number of buckets will do.
    """
    from pyspark.ml.feature import HashingTF

    vec = HashingTF(inputCol=terms_col, outputCol="_tf",
                    numFeatures=num_features).transform(docs.select("article_id", terms_col))
    sparse = F.unwrap_udt("_tf")
    return (vec.select("article_id", F.explode(F.arrays_zip(
                sparse["indices"].alias("bucket"), sparse["values"].alias("tf"))).alias("e"))
            .select("article_id", F.col("e.bucket").cast("int").alias("bucket"),
                    F.col("e.tf").cast("long").alias("tf")))
