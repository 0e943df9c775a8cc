"""Registered queries: reports over the stored tables."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import functions as F

from custfold import config as C
from custfold.catalog import REGISTRY, register
from custfold.operators import activate, ingest, master as M, runlog
from custfold.oracle import duck as D
from custfold.plans import pipeline, reports as R
from custfold.session import ensure_checkpoint_dir
from custfold.sources.fixtures import fixture

BR = D._in_list(C.BRANDS)
CNT = "CAST(count(*) AS BIGINT)"


def _cnt(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT)"


def _m(spark, sf):
    return pipeline.stored_master(spark, sf)


def _pos(spark, sf):
    return pipeline.stored_source(spark, sf, "revel_customers")


def _news(spark, sf):
    return pipeline.stored_source(spark, sf, "newsletter_signups")


def _state(spark, sf):
    return fixture(spark, sf, "push_state")


@register("pos_by_brand", D.with_ctes(["revel_customers"], f"""
SELECT brand, {CNT} AS total, {_cnt('email_ok')} AS usable, {_cnt('email_opt_in')} AS opted_in
FROM revel_customers GROUP BY brand"""))
def q_pos_by_brand(spark, sf):
    return R.pos_by_brand(_pos(spark, sf))


@register("pos_rejections", D.with_ctes(["revel_customers"], f"""
SELECT split_part(email_reason, ':', 1) AS reason, {CNT} AS n FROM revel_customers WHERE NOT email_ok GROUP BY 1"""))
def q_pos_rejections(spark, sf):
    return R.pos_rejections(_pos(spark, sf))


@register("pos_summary", D.with_ctes(["revel_customers"], f"""
SELECT {CNT} AS total, {_cnt('email_ok')} AS usable, {_cnt('email_ok AND email_opt_in')} AS mailable
FROM revel_customers"""))
def q_pos_summary(spark, sf):
    return R.pos_summary(_pos(spark, sf))


@register("pos_top_reasons", D.with_ctes(["revel_customers"], f"""
SELECT split_part(email_reason, ':', 1) AS reason_class, email_reason, n FROM (
  SELECT email_reason, {CNT} AS n FROM revel_customers WHERE NOT email_ok GROUP BY 1
  ORDER BY n DESC, email_reason LIMIT 8) q"""))
def q_pos_top_reasons(spark, sf):
    return R.pos_top_reasons(_pos(spark, sf))


@register("wifi_by_market", D.with_ctes(["wifi_guests"], f"""
SELECT lastmarket AS market, {CNT} AS n FROM wifi_guests WHERE lastmarket IS NOT NULL GROUP BY 1"""))
def q_wifi_by_market(spark, sf):
    return R.wifi_by_market(fixture(spark, sf, "wifi_guests"))


@register("wifi_missing_email", D.with_ctes(["wifi_guests"], f"""
SELECT {_cnt("email IS NULL OR email = ''")} AS missing_email, {CNT} AS total FROM wifi_guests"""))
def q_wifi_missing_email(spark, sf):
    return R.wifi_missing_email(fixture(spark, sf, "wifi_guests"))


@register("quality_totals", D.with_ctes(["master"], f"""
SELECT {CNT} AS people, {_cnt('first_name IS NOT NULL')} AS has_first, {_cnt('last_name IS NOT NULL')} AS has_last,
  {_cnt('birthday IS NOT NULL')} AS has_birthday, {_cnt('nationality IS NOT NULL')} AS has_nationality,
  {_cnt('len(sources) > 1')} AS multi_source FROM master"""))
def q_quality_totals(spark, sf):
    return R.quality_totals(_m(spark, sf))


@register("tag_distribution", D.with_ctes(["master"], f"""
SELECT tag, {CNT} AS n FROM (SELECT unnest(tags) AS tag FROM master) q GROUP BY tag ORDER BY n DESC, tag LIMIT 40"""))
def q_tag_distribution(spark, sf):
    return R.tag_distribution(_m(spark, sf))


@register("source_overlap", D.with_ctes(["master"], f"""
SELECT array_to_string(list_sort(sources), ' + ') AS combo, {CNT} AS n FROM master GROUP BY 1"""))
def q_source_overlap(spark, sf):
    return R.source_overlap(_m(spark, sf))


@register("duplicate_report", D.with_ctes(["master"], f"""
SELECT email, duplicate_of, dup_reason, (SELECT {CNT} FROM master WHERE duplicate_of IS NOT NULL) AS duplicates
FROM master WHERE duplicate_of IS NOT NULL ORDER BY duplicate_of, email LIMIT 15"""))
def q_duplicate_report(spark, sf):
    return R.duplicate_report(_m(spark, sf))


@register("no_brand_report", D.with_ctes(["master"], f"""
SELECT email, array_to_string(tags, ',') AS tags,
  (SELECT {CNT} FROM master WHERE NOT list_has_any(tags, {BR.replace('(', '[').replace(')', ']')})) AS no_brand
FROM master WHERE NOT list_has_any(tags, {BR.replace('(', '[').replace(')', ']')}) ORDER BY email LIMIT 10"""))
def q_no_brand_report(spark, sf):
    return R.no_brand_report(_m(spark, sf))


_CONSENT = f"{_cnt('allow_email')} AS consented, {_cnt('allow_email = false')} AS opted_out, " \
           f"{_cnt('allow_email IS NULL')} AS unknown"


@register("consent_overall", D.with_ctes(["master"], f"SELECT {_CONSENT} FROM master"))
def q_consent_overall(spark, sf):
    return R.consent_overall(_m(spark, sf))


@register("consent_by_source", D.with_ctes(["master"], f"""
SELECT array_to_string(list_sort(sources), ' + ') AS combo, {_CONSENT} FROM master GROUP BY 1"""))
def q_consent_by_source(spark, sf):
    return R.consent_by_source(_m(spark, sf))


_BRAND_VALUES = "(SELECT unnest(" + BR.replace("(", "[").replace(")", "]") + ") AS brand)"


@register("consent_by_brand", D.with_ctes(["master"], f"""
SELECT b.brand, {_CONSENT} FROM {_BRAND_VALUES} b JOIN master m ON list_contains(m.tags, b.brand) GROUP BY b.brand"""))
def q_consent_by_brand(spark, sf):
    return R.consent_by_brand(_m(spark, sf))


_PUSH_BY_BRAND = f"""
SELECT b.brand, coalesce(t.tagged, 0) AS tagged, coalesce(s.ok, 0) AS ok, coalesce(s.failed, 0) AS failed,
  coalesce(s.conflict, 0) AS conflict, coalesce(t.tagged, 0) - coalesce(s.ok, 0) AS pending,
  CAST(CASE WHEN coalesce(t.tagged, 0) > 0 THEN floor(coalesce(s.ok, 0) * 100.0 / t.tagged + 0.5) ELSE 0 END AS BIGINT)
    AS progress, true AS configured
FROM {_BRAND_VALUES} b
LEFT JOIN (SELECT b2.brand, {CNT} AS tagged FROM {_BRAND_VALUES} b2 JOIN master m ON list_contains(m.tags, b2.brand)
           GROUP BY 1) t ON t.brand = b.brand
LEFT JOIN (SELECT brand, {_cnt("status = 'ok'")} AS ok, {_cnt("status = 'failed'")} AS failed,
             {_cnt("status = 'conflict'")} AS conflict FROM push_state GROUP BY brand) s ON s.brand = b.brand"""


@register("push_by_brand", D.with_ctes(["master", "push_state"], _PUSH_BY_BRAND))
def q_push_by_brand(spark, sf):
    return R.push_by_brand(_m(spark, sf), _state(spark, sf))


@register("brand_coverage", D.with_ctes(["master", "push_state"], f"""
SELECT brand, tagged, ok AS pushed,
  (SELECT {_cnt('duplicate_of IS NOT NULL')} FROM master) AS duplicates_held_back,
  (SELECT {_cnt('NOT list_has_any(tags, ' + BR.replace('(', '[').replace(')', ']') + ')')} FROM master) AS no_brand
FROM ({_PUSH_BY_BRAND}) q"""))
def q_brand_coverage(spark, sf):
    return R.brand_coverage(_m(spark, sf), _state(spark, sf))


@register("master_summary", D.with_ctes(["master"], f"""
SELECT {CNT} AS people, {_cnt('allow_email')} AS consented, {_cnt('allow_email IS NULL')} AS consent_unknown,
  {_cnt('allow_email = false')} AS opted_out, {_cnt('duplicate_of IS NOT NULL')} AS duplicates_held_back,
  {_cnt('needs_push')} AS awaiting_push FROM master"""))
def q_master_summary(spark, sf):
    return R.master_summary(_m(spark, sf))


@register("minors_by_source", D.with_ctes(["minor_ledger"], f"""
SELECT source_table, {CNT} AS people FROM minor_ledger GROUP BY 1"""))
def q_minors_by_source(spark, sf):
    full, _ = M.record_minors(pipeline.stored_sources(spark, sf))
    return R.minors_by_source(full)


@register("segment_counts", D.with_ctes(["master"], f"""
SELECT brand, country, venue, {CNT} AS people FROM master GROUP BY 1, 2, 3
ORDER BY people DESC, brand NULLS FIRST, country NULLS FIRST, venue NULLS FIRST LIMIT 25"""))
def q_segment_counts(spark, sf):
    return R.segment_counts(_m(spark, sf))


@register("corrected_domains_report", D.with_ctes(["wifi_guests", "domain_corrections"], f"""
SELECT dc.wrong || ' -> ' || dc.correct AS correction, {CNT} AS records
FROM domain_corrections dc JOIN wifi_guests w ON lower(split_part(w.email, '@', 2)) = dc.wrong
GROUP BY 1 ORDER BY records DESC, correction LIMIT 15"""))
def q_corrected_domains_report(spark, sf):
    corr = spark.createDataFrame(sorted(C.DOMAIN_CORRECTIONS.items()), "wrong string, correct string")
    return R.corrected_domains_report(fixture(spark, sf, "wifi_guests"), corr)


@register("tags_json_sample", D.with_ctes(["master"], """
SELECT email, array_to_string(tags, ',') AS tags,
  CASE WHEN len(tags) = 0 THEN '[]' ELSE '["' || array_to_string(tags, '", "') || '"]' END AS como_format
FROM master ORDER BY email LIMIT 5"""))
def q_tags_json_sample(spark, sf):
    return R.tags_json_sample(_m(spark, sf))


@register("signup_totals", D.with_ctes(["newsletter_signups"], f"""
SELECT {CNT} AS total, {_cnt("como_status = 'ok'")} AS pushed, {_cnt("como_status = 'exists'")} AS already_there,
  {_cnt("como_status = 'failed'")} AS failed, {_cnt('como_status IS NULL')} AS not_tried FROM newsletter_signups"""))
def q_signup_totals(spark, sf):
    return R.signup_totals(_news(spark, sf))


@register("signup_by_site", D.with_ctes(["newsletter_signups"], f"""
SELECT brand, site, {CNT} AS n FROM newsletter_signups GROUP BY 1, 2"""))
def q_signup_by_site(spark, sf):
    return R.signup_by_site(_news(spark, sf))


@register("signup_latest", D.with_ctes(["newsletter_signups"], """
SELECT email, brand, site, como_status, como_detail, strftime(signed_up_at, '%Y-%m-%d %H:%M:%S.%f') AS signed_up_at
FROM newsletter_signups ORDER BY newsletter_signups.signed_up_at DESC, email LIMIT 50"""))
def q_signup_latest(spark, sf):
    return R.signup_latest(_news(spark, sf)).withColumn(
        "signed_up_at", F.date_format("signed_up_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("latest_runs", D.with_ctes(["run_log"], """
SELECT id, job, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS started_at,
  strftime(finished_at, '%Y-%m-%d %H:%M:%S.%f') AS finished_at, status
FROM run_log ORDER BY run_log.started_at DESC, id LIMIT 50"""))
def q_latest_runs(spark, sf):
    return R.latest_runs(fixture(spark, sf, "run_log")).withColumn(
        "started_at", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")).withColumn(
        "finished_at", F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("conflict_queue", D.with_ctes(["push_state", "master"], """
SELECT s.email, s.brand, s.status, s.detail, strftime(s.last_pushed_at, '%Y-%m-%d %H:%M:%S') AS last_pushed_at, m.first_name, m.last_name, array_to_string(m.tags, ',') AS tags
FROM push_state s LEFT JOIN master m ON m.email = s.email
WHERE s.status IN ('conflict', 'failed')
ORDER BY s.status, s.last_pushed_at DESC, s.email, s.brand LIMIT 200"""))
def q_conflict_queue(spark, sf):
    return R.conflict_queue(_state(spark, sf), _m(spark, sf)).withColumn(
        "last_pushed_at", F.date_format("last_pushed_at", "yyyy-MM-dd HH:mm:ss"))


@register("preflight_inbox_collisions", D.with_ctes(["master"], f"""
SELECT email_key, {CNT} AS records, min(email) AS first_email FROM master
WHERE needs_push AND duplicate_of IS NULL AND email_key IS NOT NULL
GROUP BY email_key HAVING count(*) > 1 ORDER BY email_key LIMIT 25"""))
def q_preflight_inbox(spark, sf):
    return R.preflight_inbox_collisions(_m(spark, sf))


_SETTLED = """
SELECT m.email, s.brand, s.status FROM master m JOIN push_state s ON s.email = m.email
WHERE m.needs_push AND s.status IN ('ok', 'exists') ORDER BY m.email, s.brand LIMIT 25"""


@register("preflight_already_settled", D.with_ctes(["master", "push_state"], _SETTLED))
def q_preflight_settled(spark, sf):
    return R.preflight_already_settled(_m(spark, sf), _state(spark, sf))


_LEAKED = "SELECT email, duplicate_of FROM master WHERE needs_push AND duplicate_of IS NOT NULL ORDER BY email LIMIT 25"


@register("preflight_leaked_duplicates", D.with_ctes(["master"], _LEAKED))
def q_preflight_leaked(spark, sf):
    return R.preflight_leaked_duplicates(_m(spark, sf))


_UNROUTED = (f"SELECT email, array_to_string(tags, ',') AS tags FROM master WHERE needs_push AND "
             f"NOT list_has_any(tags, {BR.replace('(', '[').replace(')', ']')}) ORDER BY email LIMIT 25")


@register("preflight_unrouted", D.with_ctes(["master"], _UNROUTED))
def q_preflight_unrouted(spark, sf):
    return R.preflight_unrouted(_m(spark, sf))


_COLL = ("SELECT email_key FROM master WHERE needs_push AND duplicate_of IS NULL AND email_key IS NOT NULL "
         "GROUP BY email_key HAVING count(*) > 1 ORDER BY email_key LIMIT 25")


@register("preflight_summary", D.with_ctes(["master", "push_state"], f"""
SELECT check_no, "check", least(n, 25) AS count, n AS total, n = 0 AS pass,
  (SELECT {_cnt('needs_push AND duplicate_of IS NULL')} FROM master) AS queued,
  (SELECT bool_and(x = 0) FROM (SELECT count(*) AS x FROM ({_COLL}) a UNION ALL SELECT count(*) FROM ({_SETTLED}) b
     UNION ALL SELECT count(*) FROM ({_LEAKED}) c UNION ALL SELECT count(*) FROM ({_UNROUTED}) d) z) AS all_clear
FROM (
  SELECT 1 AS check_no, 'No two queued records share an inbox' AS "check", {CNT} AS n FROM ({_COLL.replace(' LIMIT 25', '')}) a
  UNION ALL SELECT 2, 'Nobody already in Como is queued again', {CNT} FROM ({_SETTLED.replace(' LIMIT 25', '')}) b
  UNION ALL SELECT 3, 'No records flagged as duplicates are queued', {CNT} FROM ({_LEAKED.replace(' LIMIT 25', '')}) c
  UNION ALL SELECT 4, 'Every queued record has a brand tag', {CNT} FROM ({_UNROUTED.replace(' LIMIT 25', '')}) d) q"""))
def q_preflight_summary(spark, sf):
    return R.preflight_summary(_m(spark, sf), _state(spark, sf))


def _sync_state(spark, sf):
    return ingest.advance_watermark(None, fixture(spark, sf, "revel_raw"))


@register("pipeline_overview", D.with_ctes(["wifi_guests", "revel_customers", "master", "push_state"], f"""
SELECT 'wifi' AS stage, {CNT} AS rows, CAST(NULL AS BIGINT) AS usable, CAST(NULL AS BIGINT) AS pending,
  CAST(NULL AS BIGINT) AS ok, CAST(NULL AS BIGINT) AS failed, CAST(NULL AS BIGINT) AS conflict,
  strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') AS last_load, 'document store' AS detail, CAST(NULL AS BOOLEAN) AS warn
FROM wifi_guests
UNION ALL SELECT 'revel', {CNT}, {_cnt('email_ok')}, NULL, NULL, NULL, NULL,
  strftime(max(updated_at), '%Y-%m-%d %H:%M:%S'), 'up to date', false FROM revel_customers
UNION ALL SELECT 'master', {CNT}, NULL, {_cnt('needs_push')}, NULL, NULL, NULL, NULL,
  CAST({_cnt('needs_push')} AS VARCHAR) || ' awaiting push', {_cnt('needs_push')} > 0 FROM master
UNION ALL SELECT 'como', {_cnt("status = 'ok'")}, NULL, NULL, {_cnt("status = 'ok'")}, {_cnt("status = 'failed'")},
  {_cnt("status = 'conflict'")}, strftime(max(last_pushed_at), '%Y-%m-%d %H:%M:%S'),
  CAST({_cnt("status = 'failed'")} AS VARCHAR) || ' failed, ' || CAST({_cnt("status = 'conflict'")} AS VARCHAR)
    || ' conflicts', {_cnt("status IN ('failed', 'conflict')")} > 0 FROM push_state"""))
def q_pipeline_overview(spark, sf):
    out = R.pipeline_overview(fixture(spark, sf, "wifi_guests"), _pos(spark, sf), _sync_state(spark, sf),
                              _m(spark, sf), _state(spark, sf))
    return out.withColumn("last_load", F.date_format("last_load", "yyyy-MM-dd HH:mm:ss"))


@register("possible_duplicates_top", D.with_ctes(["master"], """
SELECT lower(trim(first_name)) AS first_name, lower(trim(last_name)) AS last_name,
  strftime(birthday, '%Y-%m-%d') AS birthday, CAST(count(*) AS BIGINT) AS records, min(email) AS first_email
FROM master WHERE duplicate_of IS NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
GROUP BY 1, 2, master.birthday HAVING count(*) > 1
ORDER BY records DESC, 1, 2, master.birthday NULLS FIRST LIMIT 20"""))
def q_possible_duplicates_top(spark, sf):
    return R.top_possible_duplicates(M.possible_duplicates(_m(spark, sf))).withColumn(
        "birthday", F.date_format("birthday", "yyyy-MM-dd"))


for _name in ["quality_totals", "consent_overall", "consent_by_source", "consent_by_brand", "master_summary"]:
    _fn, _sql = REGISTRY[_name]

    def _over_prior(spark, sf, fn=_fn):
        with pipeline.over_prior():
            return fn(spark, sf)

    register(f"{_name}_prior", D.over_prior(_sql))(_over_prior)


# A master on which the duplicate pass has not run, one whose duplicates were
# queued again, a brand in mid-backfill, and signups with recorded outcomes.
_OPEN = _COLL.replace("SELECT email_key", f"SELECT email_key, {CNT} AS records, min(email) AS first_email").replace(" AND duplicate_of IS NULL", "")
_UNFLAGGED = "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS duplicate_of, true AS needs_push) FROM master"


def _unflagged(spark, sf):
    return _m(spark, sf).withColumn("duplicate_of", F.lit(None).cast("string")).withColumn("needs_push", F.lit(True))


@register("preflight_inbox_collisions_unflagged", D.with_ctes(["master"], _OPEN.replace("FROM master", f"FROM ({_UNFLAGGED}) m")))
def q_preflight_inbox_unflagged(spark, sf):
    return R.preflight_inbox_collisions(_unflagged(spark, sf))


@register("preflight_collision_members", D.with_ctes(["master"], f"""
SELECT email_key, CAST(count(*) OVER (PARTITION BY email_key) AS BIGINT) AS records, email FROM ({_UNFLAGGED}) m
WHERE email_key IS NOT NULL QUALIFY count(*) OVER (PARTITION BY email_key) > 1"""))
def q_preflight_collision_members(spark, sf):
    return R.preflight_collision_members(_unflagged(spark, sf))


@register("preflight_leaked_duplicates_requeued", D.with_ctes(["master"], _LEAKED.replace("needs_push AND ", "")))
def q_preflight_leaked_requeued(spark, sf):
    return R.preflight_leaked_duplicates(_m(spark, sf).withColumn("needs_push", F.lit(True)))


@register("pipeline_overview_backfill", D.with_ctes(["revel_customers"], f"""
SELECT 'revel' AS stage, {CNT} AS rows, {_cnt('email_ok')} AS usable, 'backfilling: Bonbird' AS detail, true AS warn FROM revel_customers"""))
def q_pipeline_overview_backfill(spark, sf):
    state = ingest.advance_watermark(None, fixture(spark, sf, "revel_raw")).withColumn("backfill_complete", F.col("brand") != "Bonbird")
    out = R.pipeline_overview(None, _pos(spark, sf), state, None, None)
    return out.where("stage = 'revel'").select("stage", "rows", "usable", "detail", "warn")


@register("signup_totals_after_push", D.with_ctes(["newsletter_signups", "push_responses"], f"""
SELECT {CNT} AS total, {_cnt("st = 'ok'")} AS pushed, {_cnt("st = 'exists'")} AS already_there, {_cnt("st = 'failed'")} AS failed,
  {_cnt('st IS NULL')} AS not_tried
FROM newsletter_signups n LEFT JOIN (
  SELECT email, arg_max(CASE WHEN coalesce(json_extract_string(create_body, '$.status') = 'ok', false) THEN 'ok'
    WHEN contains(coalesce(create_body, 'null'), 'already exists') THEN 'exists' ELSE 'failed' END, attempt) AS st
  FROM push_responses GROUP BY email) o ON o.email = n.email"""))
def q_signup_totals_after_push(spark, sf):
    done = activate.push_outcome_signup(fixture(spark, sf, "push_responses"))
    return R.signup_totals(activate.apply_signup_outcomes(_news(spark, sf), done))


_BUNDLE = """SELECT '{report}' AS report, {key} AS key, CAST(count(*) AS BIGINT) AS people,
  CAST(count(*) FILTER (WHERE allow_email) AS BIGINT) AS consented, CAST(count(*) FILTER (WHERE allow_email = false) AS BIGINT) AS opted_out,
  CAST(count(*) FILTER (WHERE allow_email IS NULL) AS BIGINT) AS unknown, CAST(count(first_name) AS BIGINT) AS has_first,
  CAST(count(last_name) AS BIGINT) AS has_last, CAST(count(birthday) AS BIGINT) AS has_birthday, CAST(count(nationality) AS BIGINT) AS has_nationality,
  CAST(count(*) FILTER (WHERE len(sources) > 1) AS BIGINT) AS multi_source
FROM {rows} WHERE {key} IS NOT NULL GROUP BY 2"""
_PER_TAG = "(SELECT *, unnest(list_distinct(tags)) AS t FROM master) q"
_BUNDLES = [("total", "''", "master"), ("sources", "array_to_string(list_sort(sources), ' + ')", "master"), ("tag", "t", _PER_TAG),
            ("brand", "CASE WHEN t IN ('PICKL', 'BONBIRD', 'SOUTHPOUR') THEN t END", _PER_TAG),
            *[(f"segment {c}", c, "master") for c in ("src_system", "brand", "country", "venue")]]


@register("report_bundle", D.with_ctes(["master"], " UNION ALL ".join(_BUNDLE.format(report=r, key=k, rows=q) for r, k, q in _BUNDLES)))
def q_report_bundle(spark, sf):
    """The reports over the master's own columns, from one scan."""
    return R.report_bundle(pipeline.stored_master(spark, sf))


@register("report_bundle_prior", D.over_prior(D.with_ctes(["master"], " UNION ALL ".join(_BUNDLE.format(report=r, key=k, rows=q) for r, k, q in _BUNDLES))))
def q_report_bundle_prior(spark, sf):
    return R.report_bundle(pipeline.stored_master(spark, sf, with_prior=True))


_LOG_SQL = f"""
SELECT 'revel' AS job, 'ok' AS status, metric, n FROM (
  SELECT unnest(['rows', 'discarded', 'ok', 'rejected']) AS metric, unnest([count(*), count(*) FILTER (WHERE c = 'discarded'), count(*) FILTER (WHERE c = 'ok'),
    count(*) FILTER (WHERE c = 'rejected')]) AS n FROM (
    SELECT CASE WHEN split_part(email_reason, ':', 1) IN {D._in_list(C.DISCARD_REASONS)} THEN 'discarded' WHEN email_reason IS NULL THEN 'ok' ELSE 'rejected' END AS c
    FROM revel_typed WHERE revel_id IS NOT NULL AND revel_id <> '') q) r
UNION ALL SELECT 'master', 'ok', src, CAST(count(*) AS BIGINT) FROM canon_one GROUP BY src
UNION ALL SELECT 'master', 'ok', unnest(['people', 'changed']), unnest([count(*), count(*)]) FROM merged_full
UNION ALL SELECT 'master', 'failed', NULL, NULL"""


@register("run_log_of_jobs", D.with_ctes(["revel_typed", "canon_one", "merged_full"], _LOG_SQL))
def q_run_log_of_jobs(spark, sf):
    """The log that an ingest, a rebuild and a rebuild without sources leave."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jobs-{uuid.uuid4().hex}"
    log = f"{root}/log"
    runlog.ingest_pos_logged(spark, fixture(spark, sf, "revel_raw"), f"{root}/pos", log)
    runlog.rebuild_logged(spark, pipeline.stored_sources(spark, sf), f"{root}/merged", log)
    with contextlib.suppress(ValueError):  # logged as failed
        runlog.rebuild_logged(spark, {}, f"{root}/none", log)
    return runlog.log_metrics(spark.read.schema(runlog.LOG_SCHEMA).parquet(log)).select("job", "status", "metric", "n")
