"""Benchmark the registered queries.

Runs each headline query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line::

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is written to the ``noop`` sink (every row and column is produced,
nothing is stored).  One untimed warm-up pass runs first; the reported time
per query is the median of ``$BENCH_RUNS`` (default 3) timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodestar.plans.registry import QUERIES  # noqa: E402
from lodestar.session import local_session  # noqa: E402

HEADLINE = [
    "base_profile", "base_profile_given_region", "content_terms", "article_terms",
    "vocabulary", "vocabulary_small", "tfidf", "top_keywords", "article_top_terms",
    "keyword_vectors", "document_vectors", "article_clicks", "user_embedding",
    "user_embedding_plain", "latest_event", "dev_sample", "hashing_tf", "word_vectors",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "8")),
                          app="lodestar-bench")
    failed = {}
    for name in names:
        try:
            run(spark, name, sf_dir)
        except Exception as exc:  # keep timing the others; report the failure
            failed[name] = f"{type(exc).__name__}: {exc}"[:300]
    times = {}
    for name in names:
        if name not in failed:
            times[name] = round(statistics.median(run(spark, name, sf_dir)
                                                  for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus, "runs": runs,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
