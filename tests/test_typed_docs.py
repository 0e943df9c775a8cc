"""Typed document ingest: kinds, widening, presence, odd documents."""

import datetime as dt
import itertools
import json

from custfold.operators import typed_docs as TD


def docs(spark, *bodies, start=0):
    return spark.createDataFrame([(start + i, f"d{i}", b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "_seq long, doc_id string, body string")


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def test_kinds_and_least_types(spark):
    raw = docs(spark, {"A": 1, "b": True, "c": 1.5, "d": "2024-01-02", "e": "2024-01-02T03:04:05Z", "f": {"x": [1]}, "g": [1], "h": "x", "i": None, "j": 2 ** 60, "k": 10 ** 25, 'q"x.': "y"},
               {"a": None, "c": 2, "d": "2024-01-02 10:00", "j": 0.5, "h": 3, "e": "2024-01-02T03:04"}, "[1, 2]", None, "{bad", '"text"', "{}")
    kinds = {r["field"]: (r["spellings"], set(r["kinds"])) for r in TD.field_kinds(raw).collect()}
    assert kinds["a"] == (["A", "a"], {"BIGINT"}) and kinds["i"] == (["i"], set()) and kinds["k"][1] == {"TEXT"}
    assert kinds["j"][1] == {"LONG", "DOUBLE"} and kinds["d"][1] == {"DATE", "TIMESTAMP"}
    got = TD.ingest_docs_typed(None, raw)
    assert types(got) == {"doc_id": "string", "a": "bigint", "b": "boolean", "c": "double", "d": "timestamp", "e": "timestamp", "f": "string", "g": "string",
                          "h": "string", "j": "string", "k": "string", 'q"x.': "string", "updated_at": "timestamp_ntz"}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == 7 and rows["d0"]["a"] == 1 and rows["d0"]["j"] == str(2 ** 60) and rows["d0"]["k"] == str(10 ** 25)
    assert rows["d0"]["f"] == '{"x":[1]}' and rows["d0"]["e"] == dt.datetime(2024, 1, 2, 3, 4, 5) and rows["d1"]["c"] == 2.0 and rows["d1"]["h"] == "3"
    assert all(rows[d]["a"] is None for d in ("d1", "d2", "d3", "d4", "d5", "d6"))


def test_widening_is_free_of_order_and_keeps_values(spark):
    values = [1, 2.5, True, "x", "2024-01-02", "2024-01-02T00:00:00Z", None, {"z": 1}]
    pairs = dict(enumerate(itertools.combinations(values, 2)))  # one field per pair
    first, second = ({f"p{i}": p[k] for i, p in pairs.items()} for k in (0, 1))

    def other(doc):
        return spark.createDataFrame([(9, "other", json.dumps(doc))], "_seq long, doc_id string, body string")

    found = []
    for one, two in ((first, second), (second, first)):
        table = TD.ingest_docs_typed(TD.ingest_docs_typed(None, docs(spark, one)), other(two))
        found.append(types(table))
        stored = {r["doc_id"]: r.asDict() for r in table.collect()}
        for doc, name in ((one, "d0"), (two, "other")):
            assert all((stored[name].get(f) is None) == (v is None) for f, v in doc.items())
    together = types(TD.ingest_docs_typed(None, docs(spark, first, second)))
    assert found == [together] * 2
    assert together["p0"] == "double" and together["p22"] == "timestamp"  # 1 with 2.5, a date with a timestamp


def test_absent_fields_keep_and_nulls_overwrite(spark):
    table = TD.ingest_docs_typed(None, docs(spark, {"n": 1, "t": "a"}, {"n": 2, "t": "b"}))
    second = TD.ingest_docs_typed(table, docs(spark, {"N": None}, {"t": "c", "new": 1.5}, start=10))
    rows = {r["doc_id"]: (r["n"], r["t"], r["new"]) for r in second.collect()}
    assert rows == {"d0": (None, "a", None), "d1": (2, "c", 1.5)}
    assert types(TD.ingest_docs_typed(second, docs(spark).limit(0))) == types(second)
