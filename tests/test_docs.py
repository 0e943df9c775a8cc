"""Document ingest: lower-cased fields, nested values as JSON text, schema
growth, and partial upsert where an explicit NULL overwrites (absent keeps)."""

import datetime as dt

from custfold.operators import ingest


def test_nested_values_become_json_and_names_lower(spark):
    df = spark.createDataFrame([("d1", ("free", 3), ["a", "b"])],
                               "doc_id string, Meta struct<plan:string,n:int>, Tags array<string>")
    out = ingest.ingest_docs_evolving(None, df).collect()[0].asDict()
    assert set(out) == {"doc_id", "meta", "tags"}
    assert out["meta"] == '{"plan":"free","n":3}' and out["tags"] == '["a","b"]'


def test_partial_upsert_explicit_null_overwrites(spark):
    t0 = dt.datetime(2024, 1, 1)
    t1 = dt.datetime(2024, 1, 2)
    b1 = spark.createDataFrame([("d1", "Ann", "Lee"), ("d2", "Bob", "Kay")], "doc_id string, fname string, lname string")
    b2 = spark.createDataFrame([("d1", None, 5), ("d3", "Cy", 1)], "doc_id string, fname string, visits bigint")
    table = ingest.upsert_docs_partial(ingest.upsert_docs_partial(None, b1, run_ts=t0), b2, run_ts=t1)
    got = {r.doc_id: r for r in table.collect()}
    assert (got["d1"].fname, got["d1"].lname, got["d1"].visits, got["d1"].updated_at) == (None, "Lee", 5, t1)
    assert (got["d2"].fname, got["d2"].lname, got["d2"].visits, got["d2"].updated_at) == ("Bob", "Kay", None, t0)
    assert (got["d3"].fname, got["d3"].lname, got["d3"].visits) == ("Cy", None, 1)
