"""DataFrame -> DataFrame operators."""

from lodestar.operators.embedding import article_clicks, daily_states, user_embedding
from lodestar.operators.joins import bounded_broadcast
from lodestar.operators.keywords import (
    document_frequency, hashing_tf, term_frequency, tfidf, top_keywords, top_terms_table,
)
from lodestar.operators.profile import base_profile
from lodestar.operators.ranking import global_top_n
from lodestar.operators.segment import segmented_terms
from lodestar.operators.snapshot import (
    fold_changes, latest_snapshot, read_snapshot, sample_for_dev,
)
from lodestar.operators.terms import (
    build_dictionary, content_terms, drop_stopwords, keep_pos, terms_by_article, tokenize,
)
from lodestar.operators.vector_states import (
    finish_states, merge_states, read_states, save_states, vector_states,
)
from lodestar.operators.vectors import (
    document_vectors, keyword_vectors, train_word_vectors, vector_mean, vector_sum,
)

__all__ = [
    "article_clicks", "user_embedding", "bounded_broadcast", "document_frequency",
    "hashing_tf", "term_frequency", "tfidf", "top_keywords", "top_terms_table",
    "base_profile", "global_top_n", "latest_snapshot", "sample_for_dev",
    "build_dictionary", "content_terms", "drop_stopwords", "keep_pos",
    "terms_by_article", "tokenize", "document_vectors", "keyword_vectors",
    "train_word_vectors", "vector_mean", "vector_sum", "segmented_terms", "daily_states",
    "fold_changes", "read_snapshot",
    "finish_states", "merge_states", "read_states", "save_states", "vector_states",
]
