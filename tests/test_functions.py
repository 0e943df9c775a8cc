"""Golden cases stated by the rules (FIXTURES.md section 3) and edge cases."""

import datetime as dt

from pyspark.sql import functions as F

from custfold.functions import email as E
from custfold.functions import text as T


def _one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(col(F.col("v"))).collect()]


def test_gibberish_scores(spark):
    locals_ = ["sdfgsdfgsdfg", "qwrtplkjh", "aaaaaaaa", "xyzxyzxyz", "hjklhjkl", "anna", "mohammed"]
    df = spark.createDataFrame([(x,) for x in locals_], "l string")
    rows = E.with_gibberish(df, "l").collect()
    got = {r.l: (r.gibberish_score, ",".join(r.gibberish_signals)) for r in rows}
    assert got["sdfgsdfgsdfg"] == (12, "no_vowels,consonant_run,cc_density,low_diversity,repeat_bigrams")
    assert got["qwrtplkjh"] == (7, "no_vowels,consonant_run,cc_density")
    assert got["aaaaaaaa"] == (10, "repeat_char,repeat_unit,low_diversity,repeat_bigram_x3")
    assert got["xyzxyzxyz"] == (5, "low_diversity,repeat_bigrams")
    assert got["hjklhjkl"] == (11, "no_vowels,consonant_run,cc_density,mid_diversity,repeat_bigrams")
    assert got["anna"][0] == 0  # too short to judge


def test_column_and_staged_classification_agree(spark):
    raw = ["sdfgsdfgsdfg@gmail.com", " User5@Gmail.com", "test@test.com", "x@grubtech.com", None, "   ",
           "no-at", "p@mailinator.com", "a@b.co"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, email string")
    col = {r.i: (r.c.email, r.c.email_ok, r.c.email_reason)
           for r in df.select("i", E.classify_email(F.col("email")).alias("c")).collect()}
    staged = {r.i: (r.email, r.email_ok, r.email_reason) for r in E.with_email_check(df, "email").collect()}
    assert col == staged
    assert staged[1] == ("user5@gmail.com", True, None)
    assert staged[2][2] == "placeholder" and staged[3][2] == "internal_domain"
    assert staged[4] == (None, False, "missing") and staged[5] == (None, False, "missing")
    assert staged[6][2] == "bad_format" and staged[7][2] == "disposable"


def test_markets(spark):
    got = _one(spark, T.parse_market, ["pickl-united-arab-emirates-jbr", "southpour-united-arab-emirates-city-walk",
                                       "pickl-jordan-vista-4", "bonbird-united-arab-emirates-city-walk?cmd=login",
                                       "pickl", None, "x-egypt-cairo-mall"])
    assert got[0] == ["PICKL", "UAE", "JBR"]
    assert got[1] == ["SOUTHPOUR", "UAE", "CITY-WALK"]
    assert got[2] == ["PICKL", "JORDAN", "VISTA-4"]
    assert got[3] == ["BONBIRD", "UAE", "CITY-WALK"]
    assert got[4] == ["PICKL", ""]
    assert got[5] == []
    assert got[6] == ["X", "EGYPT", "CAIRO-MALL"]


def test_inbox_key_and_domain_fix(spark):
    keys = _one(spark, E.inbox_key, ["j.o.h.n@gmail.com", "john+shopping@gmail.com", "john@googlemail.com",
                                     "+x@y.com", "no-at"])
    assert keys[:3] == ["john@gmail.com"] * 3
    assert keys[3] == "@y.com" and keys[4] is None
    fixed = _one(spark, E.fix_domain, ["a@b.com@c", " User.5@GMIAL.com", "no-at", None])
    assert fixed == ["a@b.com", "user.5@gmail.com", "no-at", None]


def test_birthdays(spark):
    d = _one(spark, T.parse_birthday, ["1984-09-17", "2024-02-31", "1980-02-29T00:00:00", "abc"])
    assert d == [dt.date(1984, 9, 17), None, dt.date(1980, 2, 29), None]
    adult = _one(spark, T.is_adult, [dt.date(2006, 2, 1), dt.date(2006, 2, 2), dt.date(1900, 1, 1), None,
                                     dt.date(2030, 1, 1)], "date")
    assert adult == [True, False, True, True, True]


def test_clean_tags_keeps_first_occurrence(spark):
    df = spark.createDataFrame([(["wifi", " Pickl ", "WIFI", "", None, "uae"],), ([" ", None],)], "t array<string>")
    got = [r[0] for r in df.select(T.clean_tags(F.col("t"))).collect()]
    assert got == [["WIFI", "PICKL", "UAE"], None]


def test_clean_names(spark):
    got = _one(spark, T.clean_name, [" Unknown ", "n/a", " Ana ", None, "???"])
    assert got == [None, None, "Ana", None, None]
