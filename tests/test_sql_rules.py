"""The SQL functions of the rules: every session gets its own."""

from custfold.config import Dimensions
from custfold.functions.sql import register_rules


def test_functions_belong_to_the_session(spark):
    names = register_rules(spark)
    other = spark.newSession()
    assert register_rules(other) == names
    for s in (spark, other):
        row = s.sql("SELECT fix_domain(' A@gmial.com') AS e, is_valid_address('1@x.com') AS v, inbox_key('a.b+c@googlemail.com') AS k, "
                    "array_join(parse_market('pickl-jordan-vista-4?x'), ',') AS m, clean_tags(array(' ', NULL)) AS t").first()
        assert tuple(row) == ("a@gmail.com", False, "ab@gmail.com", "PICKL,JORDAN,VISTA-4", None)


def test_other_dimensions_replace_the_lists(spark):
    try:
        register_rules(spark, Dimensions(corrections={"wrong.com": "it's.com"}, blocked=("bad.org",), countries={"atlan-tis": "ATL"}))
        row = spark.sql("SELECT fix_domain('a@wrong.com') AS e, is_blocked_domain('x@bad.org') AS b, array_join(parse_market('pickl-atlan-tis-hall'), ',') AS m").first()
        assert tuple(row) == ("a@it's.com", True, "PICKL,ATL,HALL")
    finally:
        register_rules(spark)
