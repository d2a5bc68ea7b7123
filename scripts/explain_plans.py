"""Write PLANS.md: the physical plan tree of every registered query.

    python scripts/explain_plans.py [sf_dir]

Upstream stages that a query writes to the checkpoint folder (content terms,
vocabulary, keyword vectors) appear as ``Scan ExistingRDD`` leaves; the plans
that produce them are listed first, as "stage" sections.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.operators import content_terms, keyword_vectors  # noqa: E402
from lodestar.plans import registry as R  # noqa: E402
from lodestar.plans import warehouse as W  # noqa: E402
from lodestar.plans.registry import QUERIES  # noqa: E402
from lodestar.sources.tables import materialize  # noqa: E402


def stages(spark, d):
    """Plans of the stage tables that queries write before their final step."""
    stop, dictionary = materialize(W.stopwords(spark, d)), materialize(W.dictionary(spark, d))
    ct = R._content_terms(spark, d)
    return {
        "stage: stop words": W.stopwords(spark, d),
        "stage: dictionary": W.dictionary(spark, d),
        "stage: content terms (written as the article-terms table)":
            content_terms(W.articles(spark, d), stop, dictionary),
        "stage: keyword vectors (written as the keyword-vector table)":
            keyword_vectors(R._top(spark, d, ct), W.word_vectors(spark, d, ct)),
    }
from lodestar.session import local_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    nodes = [ln for ln in text.splitlines()
             if ln.startswith("=====") or re.match(r"^[ :|+\-*]*[A-Z][\w ]*.*\(\d+\)$", ln)
             and not ln.startswith("(") and not ln.startswith("Arguments")]
    details = re.findall(r"^(?:ReadSchema|PushedFilters|Join type): .*$", text, re.M)
    return "\n".join(nodes + [""] + details)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    out = ["# Physical plans", "",
           f"Generated by `scripts/explain_plans.py {sf_dir}` (AQE on; the initial plan, before "
           "run-time re-planning). `Scan ExistingRDD` is a stage written to the checkpoint "
           "folder earlier in the same query (content terms, vocabulary, keyword vectors); "
           "the plans producing those are the \"stage\" sections.", ""]
    for name, df in stages(spark, sf_dir).items():
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    for name, q in QUERIES.items():
        if name == "word_vectors":
            continue  # MLlib training returns a driver-built frame; nothing to plan
        out += [f"## {name}", "", "```", tree(q(spark, sf_dir)), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
