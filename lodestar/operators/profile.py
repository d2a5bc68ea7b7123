"""O1 / O2 — flat base-label table per user.

``users LEFT JOIN base_info ON id``; every user is kept, and users without a
base-info row get ``''`` for the derived region / e-mail suffix and NULL for
the passed-through attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.strings import email_domain, phone_tail

PROFILE_COLUMNS = ("uid", "gender", "age", "region", "email_suffix", "model")


def base_profile(users: DataFrame, base_info: DataFrame, region: str = "from_mobile",
                 id_col: str = "distinct_id", phone_digits: int = 11) -> DataFrame:
    """``(uid, gender, age, region, email_suffix, model)``, all strings.

    ``region="from_mobile"`` (raw layer): region is the last ``phone_digits``
    characters of ``mobile`` or ``''``.  ``region="given"`` (cleaned layer):
    ``base_info.region`` passes through unchanged.

    Both sides are usually large (one row per user), so the join is left to
    Catalyst/AQE: a sort-merge join on the id, switched to a broadcast at run
    time when ``base_info`` turns out small, with skewed ids split by AQE.
    """
    if region not in ("from_mobile", "given"):
        raise ValueError("region must be 'from_mobile' or 'given'")
    u = users.select(F.col(id_col).cast("string").alias("uid"))
    wanted = ["gender", "age", "email", "model",
              "mobile" if region == "from_mobile" else "region"]
    b = base_info.select(F.col(id_col).cast("string").alias("_bid"),
                         *[F.col(c).cast("string").alias(c) for c in wanted])
    joined = u.join(b, u["uid"] == b["_bid"], "left")
    region_col = (phone_tail(F.col("mobile"), phone_digits) if region == "from_mobile"
                  else F.col("region"))
    return joined.select(
        "uid", "gender", "age", region_col.alias("region"),
        email_domain(F.col("email")).alias("email_suffix"), "model",
    )
