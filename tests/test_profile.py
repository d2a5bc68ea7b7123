from lodestar.operators import base_profile


def _frames(spark):
    users = spark.createDataFrame([(u,) for u in ["1", "2", "3", "4", "5", "6"]],
                                  "distinct_id string")
    info = spark.createDataFrame([
        ("1", "F", "22", "8615686823255", "R1", "a@b.com", "m1"),
        ("2", "M", "30", "13812345678", "R2", "a@", "m2"),
        ("3", "F", "40", "123", None, "@b", "m3"),
        ("4", "M", "50", "", "R4", "a@b@c", "m4"),
        ("5", "F", "60", None, "R5", None, "m5"),
    ], "distinct_id string, gender string, age string, mobile string, region string, "
       "email string, model string")
    return users, info


def test_base_profile_from_mobile(spark):
    users, info = _frames(spark)
    out = {r.uid: r for r in base_profile(users, info).collect()}
    assert base_profile(users, info).columns == ["uid", "gender", "age", "region",
                                                "email_suffix", "model"]
    assert len(out) == users.count()
    assert (out["1"].region, out["1"].email_suffix) == ("15686823255", "b.com")
    assert (out["2"].region, out["2"].email_suffix) == ("13812345678", "")
    assert (out["3"].region, out["3"].email_suffix) == ("", "b")
    assert (out["4"].region, out["4"].email_suffix) == ("", "")
    assert (out["5"].region, out["5"].email_suffix) == ("", "")
    # user without base info: derived columns '', passed-through columns NULL
    r6 = out["6"]
    assert (r6.region, r6.email_suffix) == ("", "")
    assert r6.gender is None and r6.age is None and r6.model is None


def test_base_profile_given_region(spark):
    users, info = _frames(spark)
    out = {r.uid: r for r in base_profile(users, info, region="given").collect()}
    assert out["1"].region == "R1"
    assert out["3"].region is None
    assert out["6"].region is None and out["6"].email_suffix == ""
