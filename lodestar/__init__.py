"""lodestar — user profiling and content embedding as Spark DataFrame jobs.

Subpackages:

* ``functions`` — ``Column -> Column`` helpers (phone tail, e-mail domain,
  tokenisation, vector conversion).
* ``operators`` — ``DataFrame -> DataFrame`` operators (base profile, term
  extraction, TF-IDF keywords, word vectors, vector means, user embedding,
  latest snapshot).
* ``sources`` — table scans and sinks (ORC / Parquet tables, JDBC publish,
  external DDL).
* ``plans`` — the six end-to-end jobs and the mapping onto the driver tables.
"""

__version__ = "0.1.0"
