"""Registered queries: activation queue, payloads, outcomes, push state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from custfold import config as C
from custfold.catalog import REGISTRY, master_view, register
from custfold.operators import activate as A
from custfold.operators import lookup
from custfold.oracle import duck as D
from custfold.plans import pipeline
from custfold.session import ensure_checkpoint_dir, folder_version
from custfold.sources.fixtures import fixture

BRL = "[" + ", ".join(f"'{b}'" for b in C.BRANDS) + "]"


def _q(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


BRANDS_T = f"(SELECT unnest({BRL}) AS brand)"

# Example per-brand field configuration for payloads (a parameter: which
# platform field receives nationality and each dimension).
FIELD_MAP = {
    "PICKL": {"nationality_field": "Nationality",
              "dimension_fields": {"src_system": "GenericString1", "brand": "GenericString2",
                                   "country": "GenericString3", "venue": "GenericString4"}},
    "BONBIRD": {"dimension_fields": {"country": "Country"}},
}


def _m(spark, sf):
    return pipeline.stored_master(spark, sf)


def _state(spark, sf):
    return fixture(spark, sf, "push_state")


def _responses(spark, sf):
    return fixture(spark, sf, "push_responses")


_QUEUE = f"""
SELECT m.email, b.brand, s.status FROM master m JOIN {BRANDS_T} b ON list_contains(m.tags, b.brand)
LEFT JOIN push_state s ON s.email = m.email AND s.brand = b.brand
WHERE m.duplicate_of IS NULL AND (s.status IS NULL OR s.status NOT IN ('ok', 'exists'))
  AND (s.status IS NULL OR s.status <> 'conflict')"""


@register("pending_queue", D.with_ctes(["master", "push_state"], _QUEUE))
def q_pending_queue(spark, sf):
    return A.pending_queue(_m(spark, sf), _state(spark, sf)).select("email", "brand", "status")


@register("pending_queue_capped", D.with_ctes(["master", "push_state"], f"""
SELECT email, brand, status FROM (
  SELECT *, row_number() OVER (PARTITION BY brand ORDER BY email) AS rn FROM ({_QUEUE}) q) r WHERE rn <= 100"""))
def q_pending_queue_capped(spark, sf):
    return A.pending_queue(_m(spark, sf), _state(spark, sf), limit=100).select("email", "brand", "status")


@register("pending_queue_retry_conflicts", D.with_ctes(["master", "push_state"], f"""
SELECT m.email, b.brand, s.status FROM master m JOIN {BRANDS_T} b ON list_contains(m.tags, b.brand)
LEFT JOIN push_state s ON s.email = m.email AND s.brand = b.brand
WHERE m.duplicate_of IS NULL AND (s.status IS NULL OR s.status NOT IN ('ok', 'exists'))
  AND b.brand = 'BONBIRD'"""))
def q_pending_queue_retry(spark, sf):
    return A.pending_queue(_m(spark, sf), _state(spark, sf), brand="bonbird",
                           retry_conflicts=True).select("email", "brand", "status")


@register("route_brands", D.with_ctes(["master"], f"""
SELECT m.email, b.brand FROM master m JOIN {BRANDS_T} b ON list_contains(m.tags, b.brand)"""))
def q_route_brands(spark, sf):
    return A.route_brands(_m(spark, sf))


def _reg_fields(cfg):
    parts = [
        "CASE WHEN first_name IS NOT NULL AND first_name <> '' THEN '\"firstName\":' || to_json(first_name) END",
        "CASE WHEN last_name IS NOT NULL AND last_name <> '' THEN '\"lastName\":' || to_json(last_name) END",
        "CASE WHEN birthday IS NOT NULL THEN '\"birthday\":\"' || strftime(birthday, '%d.%m.%Y') || '\"' END",
        "CASE WHEN allow_email IS NOT NULL THEN '\"allowEmail\":' || CASE WHEN allow_email THEN 'true' "
        "ELSE 'false' END END",
    ]
    cfg = cfg or {}
    if cfg.get("nationality_field"):
        f = cfg["nationality_field"]
        parts.append(f"CASE WHEN nationality IS NOT NULL AND nationality <> '' THEN '\"{f}\":' || to_json(nationality) END")
    for key, col in [("src_system", "src_system"), ("brand", "m_brand"), ("country", "country"), ("venue", "venue")]:
        f = (cfg.get("dimension_fields") or {}).get(key)
        if f:
            parts.append(f"CASE WHEN {col} IS NOT NULL AND {col} <> '' THEN '\"{f}\":' || to_json({col}) END")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


_PAYLOAD_CASE = "CASE " + " ".join(f"WHEN q.brand = '{b}' THEN {_reg_fields(FIELD_MAP.get(b))}"
                                   for b in C.BRANDS) + f" ELSE {_reg_fields(None)} END"


@register("build_payloads", D.with_ctes(["master", "push_state"], f"""
SELECT q.email, q.brand, {_PAYLOAD_CASE} AS payload
FROM ({_QUEUE}) q JOIN (SELECT email, first_name, last_name, nationality, birthday, allow_email, src_system,
  brand AS m_brand, country, venue FROM master) m ON m.email = q.email"""))
def q_build_payloads(spark, sf):
    return A.build_payloads(A.pending_queue(_m(spark, sf), _state(spark, sf)), FIELD_MAP)


@register("preview_payloads", D.with_ctes(["master"], f"""
SELECT email, array_to_string(list_filter({BRL}, lambda b: list_contains(coalesce(tags, []::VARCHAR[]), b)), ',')
  AS brands,
  '{{"customer":{{"email":' || to_json(email) || '}},"registrationData":' || {_reg_fields(None)} || '}}' AS request
FROM master"""))
def q_preview_payloads(spark, sf):
    return A.preview_payloads(_m(spark, sf))


def _codes(body):
    top = f"coalesce(json_extract_string({body}, '$.errors[*].code'), []::VARCHAR[])"
    cause = f"coalesce(json_extract_string({body}, '$.errors[*].cause[*].code'), []::VARCHAR[])"
    return (f"(CASE WHEN json_extract_string({body}, '$.status') = 'error' THEN "
            f"list_sort(list_distinct(list_filter({top} || {cause}, lambda x: x IS NOT NULL AND x <> ''))) "
            f"ELSE []::VARCHAR[] END)")


@register("push_error_codes", D.with_ctes(["push_responses"], f"""
SELECT email, brand, 'lookup' AS body, array_to_string({_codes('lookup_body')}, ',') AS codes FROM push_responses
UNION ALL SELECT email, brand, 'create', array_to_string({_codes('create_body')}, ',') FROM push_responses
UNION ALL SELECT email, brand, 'update', array_to_string({_codes('update_body')}, ',') FROM push_responses"""))
def q_push_error_codes(spark, sf):
    r = _responses(spark, sf)
    kinds = [F.struct(F.lit(k).alias("body"), F.array_join(A.error_codes(A.parse_body(F.col(f"{k}_body"))), ",").alias("codes"))
             for k in ("lookup", "create", "update")]
    return r.select("email", "brand", F.inline(F.array(*kinds)))


def _pyjson(body, width):
    """Segments between quotes: those outside strings get a space after each
    separator, those inside have characters beyond ASCII escaped."""
    esc = ("array_to_string(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) > 127 "
           "THEN '\\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE c END), '')")
    text = (f"array_to_string(list_transform(string_split({body}, '\"'), lambda s, i: CASE WHEN i % 2 = 1 "
            f"THEN replace(replace(s, ',', ', '), ':', ': ') ELSE {esc} END), '\"')")
    return f"substr(coalesce({text}, 'null'), 1, {width})"


def _failure(body, width=200, cut=""):
    """The text of a call that raised, else the body."""
    raised = f"substr(error_text, 1, {cut})" if cut else "error_text"
    return f"coalesce(CASE WHEN {body} IS NULL THEN {raised} END, {_pyjson(body, width)})"


def _ok(body):
    return f"coalesce(json_extract_string({body}, '$.status') = 'ok', false)"


_CREATE = f"""
SELECT email, brand,
  CASE WHEN {_ok('lookup_body')} THEN 'exists'
       WHEN NOT list_contains({_codes('lookup_body')}, '{C.CODE_CUSTOMER_NOT_FOUND}') THEN 'failed'
       WHEN {_ok('create_body')} THEN 'ok'
       WHEN list_contains({_codes('create_body')}, '{C.CODE_ALREADY_EXISTS}') THEN 'exists'
       ELSE 'failed' END AS status,
  CASE WHEN {_ok('lookup_body')} THEN {_q(C.DETAIL_LEFT_ALONE)}
       WHEN NOT list_contains({_codes('lookup_body')}, '{C.CODE_CUSTOMER_NOT_FOUND}')
         THEN {_q(C.DETAIL_NOT_CHECKED)}
       WHEN {_ok('create_body')} THEN {_q(C.DETAIL_CREATED)}
       WHEN list_contains({_codes('create_body')}, '{C.CODE_ALREADY_EXISTS}') THEN {_q(C.DETAIL_ALREADY)}
       ELSE {_failure('create_body')} END AS detail,
  CASE WHEN {_ok('lookup_body')} THEN json_extract_string(lookup_body, '$.membership.comoMemberId')
       WHEN list_contains({_codes('lookup_body')}, '{C.CODE_CUSTOMER_NOT_FOUND}') AND {_ok('create_body')}
         THEN json_extract_string(create_body, '$.membership.comoMemberId') END AS como_member_id,
  CASE WHEN {_ok('lookup_body')} THEN json_extract_string(lookup_body, '$.membership.commonExtId')
       WHEN list_contains({_codes('lookup_body')}, '{C.CODE_CUSTOMER_NOT_FOUND}') AND {_ok('create_body')}
         THEN json_extract_string(create_body, '$.membership.commonExtId') END AS common_ext_id, attempt
FROM push_responses WHERE mode = 'create'"""

_NF = f"list_contains({_codes('update_body')}, '{C.CODE_CUSTOMER_NOT_FOUND}')"
_UPDATE = f"""
SELECT email, brand,
  CASE WHEN {_ok('update_body')} THEN 'ok'
       WHEN {_NF} AND {_ok('create_body')} THEN 'ok'
       WHEN {_NF} AND list_contains({_codes('create_body')}, '{C.CODE_ALREADY_EXISTS}') THEN 'conflict'
       WHEN {_NF} THEN 'failed'
       WHEN list_contains({_codes('update_body')}, '{C.CODE_ALREADY_EXISTS}') THEN 'conflict'
       ELSE 'failed' END AS status,
  CASE WHEN {_ok('update_body')} THEN {_q(C.DETAIL_UPDATED)}
       WHEN {_NF} AND {_ok('create_body')} THEN {_q(C.DETAIL_CREATED)}
       WHEN {_NF} THEN {_failure('create_body')}
       ELSE {_failure('update_body')} END AS detail,
  CASE WHEN NOT {_ok('update_body')} AND {_NF} AND {_ok('create_body')}
       THEN json_extract_string(create_body, '$.membership.comoMemberId') END AS como_member_id,
  CASE WHEN NOT {_ok('update_body')} AND {_NF} AND {_ok('create_body')}
       THEN json_extract_string(create_body, '$.membership.commonExtId') END AS common_ext_id, attempt
FROM push_responses WHERE mode = 'update'"""


@register("push_outcome_create", D.with_ctes(["push_responses"], f"SELECT * EXCLUDE (attempt) FROM ({_CREATE}) q"))
def q_push_outcome_create(spark, sf):
    return A.push_outcome_create(_responses(spark, sf).where(F.col("mode") == "create"))


@register("push_outcome_update", D.with_ctes(["push_responses"], f"SELECT * EXCLUDE (attempt) FROM ({_UPDATE}) q"))
def q_push_outcome_update(spark, sf):
    return A.push_outcome_update(_responses(spark, sf).where(F.col("mode") == "update"))


SIGNUP_OUTCOME_SQL = f"""
  SELECT email,
    CASE WHEN {_ok('create_body')} THEN 'ok' WHEN contains(coalesce(create_body, 'null'), 'already exists')
         THEN 'exists' ELSE 'failed' END AS como_status,
    CASE WHEN {_ok('create_body')} THEN {_q(C.DETAIL_CREATED)} WHEN contains(coalesce(create_body, 'null'), 'already exists')
         THEN {_q(C.DETAIL_ALREADY)} ELSE {_failure('create_body', 300, 300)} END AS como_detail
  FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY attempt DESC) AS rn FROM push_responses) r WHERE rn = 1"""


@register("push_outcome_signup", D.with_ctes(["newsletter_signups", "push_responses"], f"""
SELECT n.email, n.brand, o.como_status, o.como_detail FROM newsletter_signups n LEFT JOIN ({SIGNUP_OUTCOME_SQL}) o
  ON o.email = n.email"""))
def q_push_outcome_signup(spark, sf):
    news = pipeline.stored_source(spark, sf, "newsletter_signups")
    out = A.apply_signup_outcomes(news, A.push_outcome_signup(_responses(spark, sf)))
    return out.select("email", "brand", "como_status", "como_detail")


@register("push_run_summary", D.with_ctes(["push_responses"], f"""
SELECT brand, CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS created,
  CAST(count(*) FILTER (WHERE status = 'exists') AS BIGINT) AS already_there,
  CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed,
  CAST(count(*) FILTER (WHERE status = 'conflict') AS BIGINT) AS conflicts
FROM ({_CREATE} UNION ALL {_UPDATE}) o GROUP BY brand"""))
def q_push_run_summary(spark, sf):
    return A.push_run_summary(A.push_outcomes(_responses(spark, sf)))


@register("record_push_state", D.with_ctes(["push_state", "push_responses"], f"""
SELECT coalesce(o.email, s.email) AS email, coalesce(o.brand, s.brand) AS brand,
  CASE WHEN o.email IS NOT NULL THEN o.status ELSE s.status END AS status,
  CASE WHEN o.email IS NOT NULL THEN substr(coalesce(o.detail, ''), 1, 500) ELSE s.detail END AS detail,
  coalesce(o.como_member_id, s.como_member_id) AS como_member_id,
  coalesce(o.common_ext_id, s.common_ext_id) AS common_ext_id,
  strftime(CASE WHEN o.email IS NOT NULL THEN {D.RUN_TS} ELSE s.last_pushed_at END, '%Y-%m-%d %H:%M:%S')
    AS last_pushed_at
FROM push_state s FULL OUTER JOIN (
  SELECT email, brand, arg_max(status, attempt) AS status, arg_max(detail, attempt) AS detail,
    arg_max(como_member_id, attempt) FILTER (WHERE como_member_id IS NOT NULL) AS como_member_id,
    arg_max(common_ext_id, attempt) FILTER (WHERE common_ext_id IS NOT NULL) AS common_ext_id
  FROM ({_CREATE} UNION ALL {_UPDATE}) a GROUP BY email, brand) o ON o.email = s.email AND o.brand = s.brand"""))
def q_record_push_state(spark, sf):
    st = A.record_push_state(_state(spark, sf), A.push_outcomes(_responses(spark, sf)))
    return st.withColumn("last_pushed_at", F.date_format("last_pushed_at", "yyyy-MM-dd HH:mm:ss"))


@register("clear_needs_push", D.with_ctes(["master", "push_state"], f"""
SELECT m.email, m.needs_push AND EXISTS (
  SELECT 1 FROM {BRANDS_T} b WHERE list_contains(m.tags, b.brand) AND NOT EXISTS (
    SELECT 1 FROM push_state s WHERE s.email = m.email AND s.brand = b.brand AND s.status = 'ok')) AS needs_push
FROM master m"""))
def q_clear_needs_push(spark, sf):
    return A.clear_needs_push(_m(spark, sf), _state(spark, sf)).select("email", "needs_push")


@register("clear_conflicts", D.with_ctes(["push_state"], """
SELECT email, brand, status FROM push_state s WHERE NOT EXISTS (
  SELECT 1 FROM push_state k WHERE k.status = 'conflict' AND k.brand = 'BONBIRD'
    AND k.email = s.email AND k.brand = s.brand)"""))
def q_clear_conflicts(spark, sf):
    st = _state(spark, sf)
    keys = st.where((F.col("status") == "conflict") & (F.col("brand") == "BONBIRD"))
    return A.clear_conflicts(st, keys).select("email", "brand", "status")


def _plan_sql(brand_cond, rate, batch, pause):
    per_call = 60.0 / max(rate, 1) if rate else C.PUSH_DEFAULT_DELAY
    batches = (f"CASE WHEN queued > 0 THEN CAST(ceil(queued / {batch}) AS BIGINT) ELSE 0 END"
               if batch and pause else "CAST(0 AS BIGINT)")
    secs = f"(floor(queued * {C.CALLS_PER_QUEUED}) * {per_call}" + \
           (f" + greatest({batches} - 1, 0) * {pause})" if batch and pause else ")")
    return f"""
SELECT queued, CAST(floor(queued * {C.CALLS_PER_QUEUED}) AS BIGINT) AS api_calls, {batches} AS batches,
  CAST(floor({secs}) AS BIGINT) AS seconds,
  CASE WHEN {secs} < 60 THEN CAST(CAST(floor({secs}) AS BIGINT) AS VARCHAR) || ' sec'
       WHEN {secs} < 3600 THEN CAST(CAST(round_even({secs} / 60, 0) AS BIGINT) AS VARCHAR) || ' min'
       ELSE printf('%.1f', {secs} / 3600) || ' hours' END AS human,
  CAST({rate or int(60 / per_call)} AS BIGINT) AS rate, {str(bool(rate and rate > C.PUSH_RATE_LIMIT)).lower()}
    AS over_limit
FROM (SELECT CAST(count(*) AS BIGINT) AS queued FROM master m
      WHERE m.duplicate_of IS NULL AND {brand_cond}
        AND NOT EXISTS (SELECT 1 FROM push_state s WHERE s.email = m.email AND s.status IN ('ok', 'exists'))) q"""


@register("push_plan", D.with_ctes(["master", "push_state"],
                                   _plan_sql(f"list_has_any(m.tags, {BRL})", 300, 100, 30)))
def q_push_plan(spark, sf):
    return A.push_plan(_m(spark, sf), _state(spark, sf), "ALL", rate=300, batch_size=100, batch_pause=30)


@register("push_plan_brand", D.with_ctes(["master", "push_state"],
                                         _plan_sql("list_contains(m.tags, 'PICKL')", 0, 0, 0)))
def q_push_plan_brand(spark, sf):
    return A.push_plan(_m(spark, sf), _state(spark, sf), "pickl")


_H = C.EXPORT_HEADINGS


_EXPORT_SQL = f"""
SELECT email AS "{_H[0]}", coalesce(first_name, '') AS "{_H[1]}", coalesce(last_name, '') AS "{_H[2]}",
  coalesce(nationality, '') AS "{_H[3]}", coalesce(strftime(birthday, '%d.%m.%Y'), '') AS "{_H[4]}",
  CASE WHEN len(coalesce(tags, []::VARCHAR[])) = 0 THEN '[]' ELSE '["' || array_to_string(tags, '", "') || '"]' END
    AS "{_H[5]}",
  CASE WHEN allow_email IS NULL THEN '' WHEN allow_email THEN 'true' ELSE 'false' END AS "{_H[6]}"
FROM master ORDER BY email"""


@register("export_members", D.with_ctes(["master"], _EXPORT_SQL))
def q_export_members(spark, sf):
    return A.export_members(_m(spark, sf))


@register("export_members_brand", D.with_ctes(["master"], _EXPORT_SQL.replace(
    "FROM master ORDER BY email", "FROM master WHERE list_contains(tags, 'BONBIRD') ORDER BY email")))
def q_export_members_brand(spark, sf):
    return A.export_members(_m(spark, sf), brand="bonbird")


@register("customer_360", D.with_ctes(["push_state", "master", "wifi_guests", "revel_customers"], """
SELECT e.email, coalesce(m.email IS NOT NULL, false) AS in_master, m.first_name, m.last_name,
  array_to_string(m.tags, ',') AS tags,
  CAST((SELECT count(*) FROM wifi_guests w WHERE w.email IS NOT NULL AND lower(w.email) = e.email) AS BIGINT)
    AS wifi_guests_rows,
  CAST((SELECT count(*) FROM revel_customers r WHERE r.email IS NOT NULL AND lower(r.email) = e.email) AS BIGINT)
    AS revel_customers_rows,
  CAST((SELECT count(*) FROM push_state s WHERE s.email = e.email) AS BIGINT) AS push_rows,
  (SELECT array_to_string(list_sort(list_distinct(list(s.brand))), ',') FROM push_state s WHERE s.email = e.email)
    AS push_brands
FROM (SELECT DISTINCT lower(trim(email)) AS email FROM push_state) e LEFT JOIN master m ON m.email = e.email"""))
def q_customer_360(spark, sf):
    src = pipeline.stored_sources(spark, sf)
    st = _state(spark, sf)
    return A.customer_360(st.select("email"), _m(spark, sf),
                          {"wifi_guests": src["wifi_guests"], "revel_customers": src["revel_customers"]}, st)


@register("customer_rows", D.with_ctes(["push_state", "wifi_guests"], """
SELECT lower(w.email) AS email, 'wifi_guests' AS "table", count(*) AS n, min(w.doc_id) AS first_key FROM wifi_guests w
WHERE lower(w.email) IN (SELECT lower(trim(email)) FROM push_state) GROUP BY 1
UNION ALL SELECT s.email, 'push_state', count(*), min(s.brand) FROM push_state s
WHERE s.email IN (SELECT lower(trim(email)) FROM push_state) GROUP BY 1"""))
def q_customer_rows(spark, sf):
    st = _state(spark, sf)
    rows = A.customer_rows(st.select("email"), {"wifi_guests": fixture(spark, sf, "wifi_guests"), "push_state": st})
    key = F.coalesce(F.get_json_object("row", "$.doc_id"), F.get_json_object("row", "$.brand"))
    return rows.groupBy("email", "table").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))


for _name in ["build_payloads"]:
    _fn, _sql = REGISTRY[_name]

    def _over_prior(spark, sf, fn=_fn):
        with pipeline.over_prior():
            return fn(spark, sf)

    register(f"{_name}_prior", D.over_prior(_sql))(_over_prior)


# Addresses a user asks for, as typed.
ASKED = ["User1@hotmail.com ", "user3@gmail.com", "USER6@GMAIL.COM", "user10@hotmail.com", "user11@example.com", "nobody@nowhere.org"]
_ASKED_SQL = "(" + ", ".join(f"'{a.strip().lower()}'" for a in ASKED) + ")"


def _lookup_table(spark, sf, name, df):
    """A table stored for lookups (once per session and state of its inputs)."""
    key = (spark.sparkContext.applicationId, sf, folder_version(spark, sf), name)
    if key not in _LOOKUPS:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lookup-{name}-{uuid.uuid4().hex}"
        _LOOKUPS[key] = lookup.store_lookup(df(), path)
    return _LOOKUPS[key]


_LOOKUPS: dict = {}
_STAMP = "strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


@register("lookup_master", D.with_ctes(["master"], f"SELECT {D.master_cols()} FROM master WHERE email IN {_ASKED_SQL}"))
def q_lookup_master(spark, sf):
    table = _lookup_table(spark, sf, "master", lambda: _m(spark, sf))
    return master_view(lookup.lookup(table, ASKED))


@register("lookup_wifi", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, fname, lname, email, dob, lastmarket, {_STAMP.format(c='updated_at')} FROM wifi_guests WHERE lower(email) IN {_ASKED_SQL}"""))
def q_lookup_wifi(spark, sf):
    table = _lookup_table(spark, sf, "wifi", lambda: pipeline.stored_source(spark, sf, "wifi_guests"))
    return lookup.lookup(table, ASKED).withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@register("lookup_pos", D.with_ctes(["revel_customers"], f"""
SELECT revel_id, brand, first_name, last_name, email, email_ok, email_opt_in, CAST(updated_date AS VARCHAR) AS updated_date, email_reason
FROM revel_customers WHERE lower(email) IN {_ASKED_SQL}"""))
def q_lookup_pos(spark, sf):
    table = _lookup_table(spark, sf, "pos", lambda: pipeline.stored_source(spark, sf, "revel_customers"))
    return lookup.lookup(table, ASKED).drop("updated_at").withColumn("updated_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss"))


@register("lookup_push", D.with_ctes(["push_state"], f"""
SELECT email, brand, status, detail, como_member_id, common_ext_id, {_STAMP.format(c='last_pushed_at')} FROM push_state WHERE email IN {_ASKED_SQL}"""))
def q_lookup_push(spark, sf):
    table = _lookup_table(spark, sf, "push", lambda: _state(spark, sf))
    return lookup.lookup(table, ASKED).withColumn("last_pushed_at", F.date_format("last_pushed_at", "yyyy-MM-dd HH:mm:ss")).orderBy("email", "brand")
