"""Document ingest with real column types (semi-structured ``VARIANT``).

The types of a batch come from one aggregate over its documents: every
top-level field is one row ``(field, kind)`` of ``variant_explode``, reduced to
one row per field before the shuffle.  A field becomes a column once some
document holds a value for it:

* BOOLEAN, BIGINT, DOUBLE, DATE, TIMESTAMP (texts of ISO form), JSON (objects and
  arrays, as JSON text), else TEXT;
* a field with values of several kinds takes the least type that holds them all:
  BIGINT and DOUBLE are DOUBLE (TEXT where a whole number has no exact double),
  DATE and TIMESTAMP are TIMESTAMP, every other mixture, and whole numbers beyond 64
  bits, are TEXT;
* a stored column is widened by the same rule when a later batch needs it, and
  its values are converted; a column is never narrowed, so no order of batches
  loses a value.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custfold import config as C
from custfold.operators.ingest import upsert_docs_partial

ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ISO_STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?\z"
EXACT_DOUBLE = 1 << 53
#: Kinds of values -> column type, least type first.
_HOLDS = [({"BOOLEAN"}, "boolean"), ({"BIGINT", "LONG"}, "bigint"), ({"BIGINT", "DOUBLE"}, "double"),
          ({"DATE"}, "date"), ({"DATE", "TIMESTAMP"}, "timestamp")]
_KIND_OF = {"boolean": {"BOOLEAN"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"}, "date": {"DATE"}, "timestamp": {"TIMESTAMP"}}


def document(json_col: str) -> Column:
    """The top-level fields of a JSON document as a map of variants (NULL for
    anything but an object)."""
    return F.expr(f"try_cast(try_parse_json(`{json_col}`) AS MAP<STRING, VARIANT>)")


def value_kind(v: Column) -> Column:
    """The kind of one value; NULL for a JSON null."""
    schema = F.schema_of_variant(v)
    text = v.cast("string")
    whole = F.try_variant_get(v, "$", "bigint")
    wide = whole.isNull() | (F.abs(whole.cast("decimal(20,0)")) > EXACT_DOUBLE)
    return (F.when(schema == "VOID", F.lit(None).cast("string"))
            .when(schema == "BOOLEAN", "BOOLEAN")
            .when(schema == "BIGINT", F.when(wide, "LONG").otherwise("BIGINT"))
            .when(schema.rlike(r"^DECIMAL\([0-9]+,0\)"), "TEXT")
            .when((schema == "DOUBLE") | schema.startswith("DECIMAL"), "DOUBLE")
            .when(schema != "STRING", "JSON")
            .when(text.rlike(ISO_DATE) & text.try_cast("date").isNotNull(), "DATE")
            .when(text.rlike(ISO_STAMP) & text.try_cast("timestamp").isNotNull(), "TIMESTAMP")
            .otherwise("TEXT"))


def field_kinds(raw: DataFrame, json_col: str = "body") -> DataFrame:
    """``field, spellings, kinds``: lower-case field names, how documents spell
    them and the kinds of their values."""
    fields = raw.select(F.explode(document(json_col)).alias("name", "value"))
    return (fields.select(F.lower("name").alias("field"), "name", value_kind(F.col("value")).alias("kind"))
            .groupBy("field").agg(F.array_sort(F.collect_set("name")).alias("spellings"), F.collect_set("kind").alias("kinds")))


def least_type(kinds: set[str]) -> str | None:
    """The least column type that holds values of these kinds."""
    if not kinds:
        return None
    return next((t for held, t in _HOLDS if kinds <= held), "string")


def column_types(kinds: list, existing: T.StructType | None = None, key: str = "doc_id", most: int = 10_000) -> dict[str, str]:
    """Field -> column type over a batch and a stored table; fields without any
    value are left out.  A table of more than ``most`` fields is refused."""
    if len(kinds) > most:
        raise ValueError(f"the documents hold more than {most} fields")
    held = {f.name: f.dataType.simpleString() for f in existing.fields} if existing else {}
    out = {}
    for r in kinds:
        old = held.get(r["field"])
        needed = set(r["kinds"])
        if old is not None and old not in _KIND_OF:
            out[r["field"]] = "string"
        elif least := least_type(needed | (_KIND_OF[old] if old else set())):
            out[r["field"]] = least
    return {**{c: t for c, t in held.items() if c not in (key, "updated_at")}, **{c: t for c, t in out.items() if c != key}}


def typed_docs(raw: DataFrame, types: dict[str, str], spellings: dict[str, list[str]], json_col: str = "body") -> DataFrame:
    """One typed column per field of the batch and ``_present``, the names of
    the fields that each document has."""
    kept = [c for c in raw.columns if c != json_col]
    doc = raw.select(*kept, document(json_col).alias("_doc"))

    def value(field: str) -> Column:
        found = [F.try_element_at("_doc", F.lit(s)) for s in spellings[field]]
        if types[field] == "string":
            return F.coalesce(*[v.cast("string") for v in found])
        if types[field] in ("date", "timestamp"):
            return F.coalesce(*[v.cast("string").try_cast(types[field]) for v in found])
        return F.coalesce(*[F.try_variant_get(v, "$", types[field]) for v in found])

    names = F.coalesce(F.map_keys("_doc"), F.array().cast("array<string>"))
    return doc.select(*kept, *[value(f).alias(f) for f in types if f in spellings], names.alias("_present"))


def ingest_docs_typed(existing: DataFrame | None, raw: DataFrame, key: str = "doc_id", order_col: str = "_seq",
                      run_ts: _dt.datetime = C.RUN_TS, json_col: str = "body") -> DataFrame:
    """Upsert JSON documents into a table with typed columns: the table is
    widened first (the types need one aggregate, run here), then every document's
    own fields overwrite (see ``upsert_docs_partial``)."""
    kinds = [r for r in field_kinds(raw, json_col).collect() if r["field"] not in (key, order_col)]
    types = column_types(kinds, existing.schema if existing is not None else None, key)
    batch = typed_docs(raw, types, {r["field"]: r["spellings"] for r in kinds}, json_col)
    if existing is not None:
        stored = {c: F.col("`" + c.replace("`", "``") + "`") for c in existing.columns}
        existing = existing.select(*[v.cast(types[c]).alias(c) if c in types else v for c, v in stored.items()])
    return upsert_docs_partial(existing, batch, key=key, run_ts=run_ts, order_col=order_col)
