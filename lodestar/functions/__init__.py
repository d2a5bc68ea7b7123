"""Column-level helpers: every function here maps ``Column`` to ``Column``."""

from lodestar.functions.strings import email_domain, phone_tail, split_terms, terms_to_string
from lodestar.functions.vectors import round_array, to_array, to_vector

__all__ = [
    "email_domain", "phone_tail", "split_terms", "terms_to_string",
    "round_array", "to_array", "to_vector",
]
