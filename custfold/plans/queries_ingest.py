"""Registered queries: document ingest, incremental loads, probes, stream."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.common import ts_ntz
from custfold.catalog import register
from custfold.oracle import duck as D
from custfold.operators import activate, ingest, landing, typed_docs
from custfold.plans import pipeline
from custfold.plans.queries_activate import SIGNUP_OUTCOME_SQL
from custfold.sources.fixtures import fixture
from custfold.session import ensure_checkpoint_dir, folder_version
from custfold.streaming.pos_sync import run_interrupted_sync
from custfold.streaming.signups import run_signup_outcome_stream, run_signup_stream

RUN_TS2 = C.RUN_TS + _dt.timedelta(days=1)


@register("ingest_docs_evolving", D.with_ctes(["wifi_batch_1", "wifi_batch_2"], """
SELECT doc_id, "Fname" AS fname, lname, CAST(NULL AS BIGINT) AS visits, CAST(NULL AS VARCHAR) AS meta
FROM wifi_batch_1
UNION ALL SELECT doc_id, fname, NULL, visits, meta FROM wifi_batch_2"""))
def q_ingest_docs_evolving(spark, sf):
    b1, b2 = fixture(spark, sf, "wifi_batch_1"), fixture(spark, sf, "wifi_batch_2")
    return ingest.ingest_docs_evolving(ingest.ingest_docs_evolving(None, b1), b2)


@register("upsert_docs_partial", D.with_ctes(["wifi_batch_1", "wifi_batch_2"], f"""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
  CASE WHEN b.doc_id IS NOT NULL THEN b.fname ELSE a."Fname" END AS fname,
  a.lname AS lname, b.visits AS visits, b.meta AS meta,
  strftime(CASE WHEN b.doc_id IS NOT NULL THEN TIMESTAMP '{RUN_TS2.isoformat(sep=' ')}'
                ELSE {D.RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM wifi_batch_1 a FULL OUTER JOIN wifi_batch_2 b ON a.doc_id = b.doc_id"""))
def q_upsert_docs_partial(spark, sf):
    b1, b2 = fixture(spark, sf, "wifi_batch_1"), fixture(spark, sf, "wifi_batch_2")
    t1 = ingest.upsert_docs_partial(None, b1, run_ts=C.RUN_TS)
    t2 = ingest.upsert_docs_partial(t1, b2, run_ts=RUN_TS2)
    return t2.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def _sync_state(spark, sf):
    """A per-brand sync state derived from the feed: one brand mid-backfill,
    two complete with a high-water mark a year before their newest row."""
    raw = fixture(spark, sf, "revel_raw")
    stamp = F.expr("try_cast(updated_date AS TIMESTAMP_NTZ)")
    return (raw.groupBy(F.col("_brand").alias("brand"))
            .agg((F.max(stamp) - F.expr("INTERVAL 365 DAYS")).alias("watermark"))
            .select("brand", F.lit(0).cast("long").alias("backfill_offset"),
                    (F.col("brand") != "Bonbird").alias("backfill_complete"), "watermark",
                    ts_ntz(C.RUN_TS).alias("last_run_at")))


_STATE_SQL = f"""
SELECT _brand AS brand, CAST(0 AS BIGINT) AS backfill_offset, _brand <> 'Bonbird' AS backfill_complete,
  max(TRY_CAST(updated_date AS TIMESTAMP)) - INTERVAL 365 DAY AS watermark, {D.RUN_TS} AS last_run_at
FROM revel_raw GROUP BY _brand"""

_SLICE_SQL = f"""
SELECT r.* FROM revel_raw r LEFT JOIN ({_STATE_SQL}) s ON s.brand = r._brand
WHERE contains(r.email, '@') AND (NOT (coalesce(s.backfill_complete, false) AND s.watermark IS NOT NULL)
  OR coalesce(TRY_CAST(r.updated_date AS TIMESTAMP) >= s.watermark - INTERVAL 1 DAY, false))"""


@register("incremental_slice", D.with_ctes(["revel_raw"], f"SELECT _seq, _brand FROM ({_SLICE_SQL}) q"))
def q_incremental_slice(spark, sf):
    return ingest.incremental_slice(fixture(spark, sf, "revel_raw"), _sync_state(spark, sf)) \
        .select("_seq", "_brand")


@register("advance_watermark", D.with_ctes(["revel_raw"], f"""
SELECT coalesce(s.brand, n.brand) AS brand, CAST(0 AS BIGINT) AS backfill_offset, true AS backfill_complete,
  strftime(CASE WHEN s.watermark IS NULL THEN n.newest WHEN n.newest IS NULL THEN s.watermark
                ELSE greatest(s.watermark, n.newest) END, '%Y-%m-%d %H:%M:%S') AS watermark,
  strftime({D.RUN_TS}, '%Y-%m-%d %H:%M:%S') AS last_run_at
FROM ({_STATE_SQL}) s FULL OUTER JOIN (
  SELECT _brand AS brand, max(TRY_CAST(updated_date AS TIMESTAMP)) AS newest FROM ({_SLICE_SQL}) q GROUP BY 1) n
ON n.brand = s.brand"""))
def q_advance_watermark(spark, sf):
    state = _sync_state(spark, sf)
    rows = ingest.incremental_slice(fixture(spark, sf, "revel_raw"), state)
    out = ingest.advance_watermark(state, rows)
    return out.withColumn("watermark", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss")) \
        .withColumn("last_run_at", F.date_format("last_run_at", "yyyy-MM-dd HH:mm:ss"))


_ONE = f"({_SLICE_SQL.replace('SELECT r.*', 'SELECT r._brand, r.updated_date')} AND r._brand = 'Pickl')"


@register("advance_watermark_one_brand", D.with_ctes(["revel_raw"], f"""
SELECT s.brand, CAST(0 AS BIGINT) AS backfill_offset, s.backfill_complete OR s.brand = 'Pickl' AS backfill_complete,
  strftime(CASE WHEN s.brand = 'Pickl' THEN greatest(s.watermark, n.newest) ELSE s.watermark END, '%Y-%m-%d %H:%M:%S') AS watermark,
  strftime(CASE WHEN s.brand = 'Pickl' THEN TIMESTAMP '{RUN_TS2.isoformat(sep=' ')}' ELSE s.last_run_at END, '%Y-%m-%d %H:%M:%S') AS last_run_at
FROM ({_STATE_SQL}) s LEFT JOIN (SELECT _brand AS brand, max(TRY_CAST(updated_date AS TIMESTAMP)) AS newest FROM {_ONE} q GROUP BY 1) n
ON n.brand = s.brand"""))
def q_advance_watermark_one_brand(spark, sf):
    """A run over one brand leaves the state of the others alone."""
    state = _sync_state(spark, sf)
    rows = ingest.incremental_slice(fixture(spark, sf, "revel_raw").where("_brand = 'Pickl'"), state)
    out = ingest.advance_watermark(state, rows, run_ts=RUN_TS2, brands=["Pickl"])
    return out.withColumn("watermark", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss")) \
        .withColumn("last_run_at", F.date_format("last_run_at", "yyyy-MM-dd HH:mm:ss"))


_JSON_FIELDS = ["fname", "lname", "visits", "meta"]


def _json_docs(spark, sf, name):
    return ingest.docs_from_json(fixture(spark, sf, name), _JSON_FIELDS)


@register("ingest_docs_json", D.with_ctes(["wifi_json_1", "wifi_json_2"], """
SELECT doc_id, body ->> '$.Fname' AS fname, body ->> '$.lname' AS lname, body ->> '$.visits' AS visits, body ->> '$.meta' AS meta
FROM (SELECT * FROM wifi_json_1 UNION ALL SELECT * FROM wifi_json_2) d"""))
def q_ingest_docs_json(spark, sf):
    one, two = (_json_docs(spark, sf, n).drop("_present", "_seq") for n in ("wifi_json_1", "wifi_json_2"))
    return ingest.ingest_docs_evolving(ingest.ingest_docs_evolving(None, one), two)


def _field_sql(f, path):
    """Last value of a field among the documents that have it."""
    return f"""(SELECT body ->> '$.{path}' FROM wifi_json_2 x WHERE x.doc_id = k.doc_id AND list_contains(json_keys(body), '{path}')
    ORDER BY _seq DESC LIMIT 1) AS {f}, (SELECT count(*) FROM wifi_json_2 x WHERE x.doc_id = k.doc_id AND list_contains(json_keys(body), '{path}')) > 0 AS has_{f}"""


@register("upsert_docs_presence", D.with_ctes(["wifi_json_1", "wifi_json_2"], f"""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
  CASE WHEN b.has_fname THEN b.fname ELSE a.body ->> '$.Fname' END AS fname,
  CASE WHEN b.has_lname THEN b.lname ELSE a.body ->> '$.lname' END AS lname, b.visits, b.meta,
  strftime(CASE WHEN b.doc_id IS NOT NULL THEN TIMESTAMP '{RUN_TS2.isoformat(sep=' ')}' ELSE {D.RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM wifi_json_1 a FULL OUTER JOIN (
  SELECT k.doc_id, {_field_sql('fname', 'Fname')}, {_field_sql('lname', 'lname')}, {_field_sql('visits', 'visits')}, {_field_sql('meta', 'meta')}
  FROM (SELECT DISTINCT doc_id FROM wifi_json_2) k) b ON a.doc_id = b.doc_id"""))
def q_upsert_docs_presence(spark, sf):
    """Absent, NULL, repeated and nested fields, document by document."""
    one, two = _json_docs(spark, sf, "wifi_json_1"), _json_docs(spark, sf, "wifi_json_2")
    t1 = ingest.upsert_docs_partial(None, one, run_ts=C.RUN_TS, order_col="_seq")
    t2 = ingest.upsert_docs_partial(t1, two, run_ts=RUN_TS2, order_col="_seq")
    return t2.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


def _typed_docs(spark, sf):
    one, two = fixture(spark, sf, "wifi_typed_1"), fixture(spark, sf, "wifi_typed_2")
    stored = typed_docs.ingest_docs_typed(None, one, run_ts=C.RUN_TS)
    return typed_docs.ingest_docs_typed(stored, two, run_ts=RUN_TS2)


def _last_sql(field, path, sql_type):
    """The second batch's value where it has the field, else the first one's."""
    return f"CAST(CASE WHEN list_contains(json_keys(b.body), '{path}') THEN b.body ->> '$.{path}' ELSE a.body ->> '$.{field}' END AS {sql_type}) AS {path}"


@register("ingest_docs_typed", D.with_ctes(["wifi_typed_1", "wifi_typed_2"], f"""
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id,
  CAST(CASE WHEN b.doc_id IS NOT NULL THEN b.body ->> '$.visits' ELSE a.body ->> '$.Visits' END AS BIGINT) AS visits,
  CAST(a.body ->> '$.vip' AS BOOLEAN) AS vip, CAST(a.body ->> '$.spend' AS DOUBLE) AS spend,
  strftime(CAST(replace(a.body ->> '$.joined', 'Z', '') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS joined,
  strftime(CAST(replace(coalesce(b.body ->> '$.born', a.body ->> '$.born'), 'Z', '') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS born,
  {_last_sql('score', 'score', 'DOUBLE')},
  CASE WHEN list_contains(json_keys(b.body), 'code') THEN b.body ->> '$.code' WHEN list_contains(json_keys(b.body), 'Code') THEN b.body ->> '$.Code'
       ELSE a.body ->> '$.code' END AS code,
  a.body ->> '$.meta' AS meta, b.body ->> '$.big' AS big, b.body ->> '$.note' AS note,
  strftime(CASE WHEN b.doc_id IS NOT NULL THEN TIMESTAMP '{RUN_TS2.isoformat(sep=' ')}' ELSE {D.RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM wifi_typed_1 a FULL OUTER JOIN wifi_typed_2 b ON a.doc_id = b.doc_id"""))
def q_ingest_docs_typed(spark, sf):
    """JSON documents into typed columns that a second batch widens."""
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("joined", "born", "updated_at")}
    return _typed_docs(spark, sf).withColumns(stamps)


def _kinds_sql(table):
    value = "json_extract(body, '$.' || k)"
    text = "(body ->> ('$.' || k))"
    return f"""SELECT lower(k) AS field, CASE json_type({value}) WHEN 'NULL' THEN NULL WHEN 'BOOLEAN' THEN 'BOOLEAN'
      WHEN 'DOUBLE' THEN CASE WHEN regexp_full_match({text}, '-?[0-9]+') THEN 'TEXT' ELSE 'DOUBLE' END
      WHEN 'OBJECT' THEN 'JSON' WHEN 'ARRAY' THEN 'JSON'
      WHEN 'VARCHAR' THEN CASE WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({text} AS DATE) IS NOT NULL THEN 'DATE'
        WHEN regexp_full_match({text}, '[0-9-]{{10}}T[0-9:]{{8}}Z') THEN 'TIMESTAMP' ELSE 'TEXT' END
      ELSE CASE WHEN TRY_CAST({text} AS BIGINT) IS NULL THEN 'TEXT' ELSE 'BIGINT' END END AS kind
    FROM (SELECT body, unnest(json_keys(body)) AS k FROM {table}) x"""


@register("ingest_docs_types", D.with_ctes(["wifi_typed_1", "wifi_typed_2"], f"""
SELECT field, CASE WHEN list_contains(ks, 'TEXT') OR list_contains(ks, 'JSON') THEN 'string' WHEN ks = ['BOOLEAN'] THEN 'boolean' WHEN ks = ['BIGINT'] THEN 'bigint'
  WHEN list_contains(ks, 'DOUBLE') AND len(list_filter(ks, lambda k: k NOT IN ('DOUBLE', 'BIGINT'))) = 0 THEN 'double' WHEN ks = ['DATE'] THEN 'date'
  WHEN list_contains(ks, 'TIMESTAMP') AND len(list_filter(ks, lambda k: k NOT IN ('DATE', 'TIMESTAMP'))) = 0 THEN 'timestamp' ELSE 'string' END AS type
FROM (SELECT field, list_sort(list(DISTINCT kind)) AS ks FROM ({_kinds_sql('wifi_typed_1')} UNION ALL {_kinds_sql('wifi_typed_2')}) q WHERE kind IS NOT NULL GROUP BY field) r"""))
def q_ingest_docs_types(spark, sf):
    """The column types that the documents of both batches give."""
    table = _typed_docs(spark, sf)
    types = [(f.name, f.dataType.simpleString()) for f in table.schema.fields if f.name not in ("doc_id", "updated_at")]
    return spark.createDataFrame(types, "field string, type string")


_LANDED: dict = {}


def _landed(spark, sf):
    """The feed landed by brand and month, and its folders (once per session)."""
    key = (spark.sparkContext.applicationId, sf, folder_version(spark, sf))
    if key not in _LANDED:
        _LANDED[key] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
        landing.land(fixture(spark, sf, "revel_raw"), f"{_LANDED[key]}/feed")
        landing.landed_periods(spark.read.parquet(f"{_LANDED[key]}/feed")).coalesce(1).write.parquet(f"{_LANDED[key]}/periods")
    return spark.read.parquet(f"{_LANDED[key]}/feed"), spark.read.parquet(f"{_LANDED[key]}/periods")


@register("incremental_slice_landed", D.with_ctes(["revel_raw"], f"SELECT _seq, _brand, email, updated_date FROM ({_SLICE_SQL}) q"))
def q_incremental_slice_landed(spark, sf):
    """The slice of a landed feed, reading only the folders the state asks for."""
    feed, periods = _landed(spark, sf)
    state = pipeline.stored(spark, sf, "sync_state", lambda: _sync_state(spark, sf))
    return landing.slice_landed(feed, periods, state).select("_seq", "_brand", "email", "updated_date")


@register("pos_sync_stream", D.with_ctes(["revel_customers"], """
SELECT revel_id, brand, first_name, last_name, email, email_ok, email_opt_in,
  CAST(updated_date AS VARCHAR) AS updated_date, email_reason FROM revel_customers"""))
def q_pos_sync_stream(spark, sf):
    """A backfill cut off, replayed and ended as a stream gives the one-shot table."""
    rows, _half, _state = run_interrupted_sync(spark, fixture(spark, sf, "revel_raw"))
    return rows.withColumn("updated_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss")).drop("updated_at")


def _sync_sql(when, where, offset, complete):
    return f"""SELECT '{when}' AS after, _brand AS brand, CAST({offset} AS BIGINT) AS backfill_offset, {complete} AS backfill_complete,
  strftime(max(TRY_CAST(updated_date AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS watermark FROM revel_raw WHERE {where} GROUP BY _brand"""


@register("pos_sync_state", D.with_ctes(["revel_raw"], f"""
{_sync_sql('replay', '_seq % 6 < 3', 'count(*)', 'false')} UNION ALL {_sync_sql('end', 'true', '0', 'true')}"""))
def q_pos_sync_state(spark, sf):
    """Brand states after the replayed epoch (half of the pages) and at the end."""
    _rows, half, last = run_interrupted_sync(spark, fixture(spark, sf, "revel_raw"))
    both = half.select(F.lit("replay").alias("after"), "*").unionByName(last.select(F.lit("end").alias("after"), "*"))
    return both.drop("last_run_at").withColumn("watermark", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss"))


@register("upsert_signups_second_batch", D.with_ctes(["signup_checked", "push_responses"], f"""
SELECT coalesce(a.email, b.email) AS email, coalesce(a.brand, b.brand) AS brand, coalesce(a.country, b.country) AS country,
  CASE WHEN a.email IS NOT NULL THEN a.site ELSE b.site END AS site, coalesce(b.first_name, a.first_name) AS first_name,
  CASE WHEN a.email IS NOT NULL AND o.email IS NOT NULL THEN 'ok' END AS como_status,
  strftime(CASE WHEN a.email IS NOT NULL THEN a.signed_up_at ELSE b.signed_up_at END, '%Y-%m-%d %H:%M:%S.%f') AS signed_up_at,
  strftime(CASE WHEN b.email IS NOT NULL THEN TIMESTAMP '{RUN_TS2.isoformat(sep=' ')}' ELSE {D.RUN_TS} END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM ({D.newsletter_sql('seq % 2 = 0')}) a FULL OUTER JOIN ({D.newsletter_sql('seq % 2 = 1')}) b ON a.email = b.email
LEFT JOIN (SELECT DISTINCT email FROM push_responses) o ON o.email = a.email"""))
def q_upsert_signups_second_batch(spark, sf):
    """A second batch keeps recorded outcomes and first values."""
    checked = ingest.accept_signups(fixture(spark, sf, "signup_events"))
    first = ingest.upsert_signups(checked.where("seq % 2 = 0"))
    sent = fixture(spark, sf, "push_responses").select("email", "attempt", F.lit("ok").alias("como_status"), F.lit("created").alias("como_detail"))
    stored = activate.apply_signup_outcomes(first, sent)
    out = ingest.upsert_signups(checked.where("seq % 2 = 1"), run_ts=RUN_TS2, existing=stored)
    return out.select("email", "brand", "country", "site", "first_name", "como_status",
                      F.date_format("signed_up_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("signed_up_at"),
                      F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


PROBES = {
    "(no filter)": "true",
    "email_opt_in=true": "email_opt_in",
    "email__contains=@": "email LIKE '%@%'",
    "updated_date__gte=1997-01-01": "updated_date >= '1997-01-01'",
    "opt_in + has email": "email_opt_in AND email LIKE '%@%'",
}


@register("filter_selectivity", D.with_ctes(["revel_raw"], " UNION ALL ".join(
    f"SELECT '{label}' AS label, CAST(count(*) FILTER (WHERE coalesce({pred}, false)) AS BIGINT) AS n, "
    f"round(count(*) FILTER (WHERE coalesce({pred}, false)) * 100.0 / count(*), 1) AS pct FROM revel_raw"
    for label, pred in PROBES.items())))
def q_filter_selectivity(spark, sf):
    return ingest.filter_selectivity(fixture(spark, sf, "revel_raw"), PROBES)


_PROFILE_COLS = ["_brand", "_seq", "email", "email_opt_in", "first_name", "last_name", "resource_uri",
                 "updated_date"]


@register("field_profile", D.with_ctes(["revel_raw"], " UNION ALL ".join(
    f"SELECT CAST(count(*) AS BIGINT) AS rows, '{c}' AS field, substr(min(CAST({c} AS VARCHAR)), 1, 70) AS sample "
    f"FROM revel_raw"
    for c in _PROFILE_COLS)))
def q_field_profile(spark, sf):
    return ingest.field_profile(fixture(spark, sf, "revel_raw"))


@register("signup_stream", D.with_ctes(["newsletter_signups"], """
SELECT email, brand, country, site, page, first_name, last_name,
  strftime(signed_up_at, '%Y-%m-%d %H:%M:%S.%f') AS signed_up_at FROM newsletter_signups"""))
def q_signup_stream(spark, sf):
    out = run_signup_stream(spark, fixture(spark, sf, "signup_events"))
    return out.select("email", "brand", "country", "site", "page", "first_name", "last_name",
                      F.date_format("signed_up_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("signed_up_at"))


@register("signup_outcome_stream", D.with_ctes(["newsletter_signups", "push_responses"], f"""
SELECT n.email, n.brand, n.country, n.site, n.first_name, n.last_name, o.como_status, o.como_detail,
  CASE WHEN o.email IS NOT NULL THEN strftime({D.RUN_TS}, '%Y-%m-%d %H:%M:%S') END AS como_at
FROM newsletter_signups n LEFT JOIN ({SIGNUP_OUTCOME_SQL}) o ON o.email = n.email"""))
def q_signup_outcome_stream(spark, sf):
    """Signups and push responses as two streams in one state; responses of half
    of the addresses arrive before their signups."""
    events, responses = fixture(spark, sf, "signup_events"), fixture(spark, sf, "push_responses")
    early = F.length("email") % 2 == 0
    out = run_signup_outcome_stream(spark, [(events.where("event_id % 3 = 0"), responses.where(early)), (events.where("event_id % 3 <> 0"), None),
                                            (None, responses.where(~early))])
    return out.select("email", "brand", "country", "site", "first_name", "last_name", "como_status", "como_detail",
                      F.date_format("como_at", "yyyy-MM-dd HH:mm:ss").alias("como_at"))
