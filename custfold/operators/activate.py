"""Activation: who still has to be sent to which brand account, with what,
and what came of it.

The push itself is an external call; here it is re-aimed as data: the
queue and payloads are an outbox DataFrame, and the platform's responses
are a response log that is turned into outcomes and a keyed state table.
Joins are on (email, brand) keys; brand lists are bounded literals.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.common import ts_ntz

RESPONSE_SCHEMA = ("struct<status:string,membership:struct<comoMemberId:string,commonExtId:string>,"
                   "errors:array<struct<code:string,cause:array<struct<code:string>>>>>")


def _brands(brands=None) -> Column:
    return F.array(*[F.lit(b) for b in (C.BRANDS if brands is None else brands)])


# ---------------------------------------------------------------------------
# Queue and routing
# ---------------------------------------------------------------------------
def route_brands(master: DataFrame, configured=None) -> DataFrame:
    """email, brand for every configured brand tag (two brands -> two rows)."""
    return master.select("email", F.explode(F.array_intersect(F.col("tags"), _brands(configured))).alias("brand"))


def pending_queue(master: DataFrame, state: DataFrame | None, brand: str | None = None,
                  limit: int | None = None, retry_conflicts: bool = False) -> DataFrame:
    """Per brand: tagged, not a duplicate, no ok/exists for that brand and
    (unless retrying) no conflict; ordered by email, optional cap per brand.

    The cap ranks within a brand; Spark limits every task to the cap before the
    shuffle (window group limit), so no task ever holds a brand's whole queue
    and the join runs once.
    """
    brands = [brand.upper()] if brand else None
    fields = ["email", "first_name", "last_name", "nationality", "birthday", "allow_email",
              "src_system", F.col("brand").alias("brand_tag"), "country", "venue"]
    q = (master.where(F.col("duplicate_of").isNull())
         .select(*fields, F.explode(F.array_intersect(F.col("tags"), _brands(brands))).alias("brand")))
    if state is not None:
        q = q.join(state.select("email", "brand", "status"), ["email", "brand"], "left")
    else:
        q = q.withColumn("status", F.lit(None).cast("string"))
    keep = F.col("status").isNull() | ~F.col("status").isin("ok", "exists")
    if not retry_conflicts:
        keep = keep & (F.col("status").isNull() | (F.col("status") != "conflict"))
    q = q.where(keep)
    if not limit:
        return q.orderBy("brand", "email")
    first = Window.partitionBy("brand").orderBy("email")
    return q.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= limit).drop("_n").orderBy("brand", "email")


# ---------------------------------------------------------------------------
# Payloads
# ---------------------------------------------------------------------------
def _registration_fields(cfg: dict | None) -> list[Column]:
    """Ordered optional fields; NULL ones are dropped by ``to_json``."""
    def truthy(c):
        return F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), F.col(c))

    out = [truthy("first_name").alias("firstName"), truthy("last_name").alias("lastName"),
           F.date_format("birthday", "dd.MM.yyyy").alias("birthday"),
           F.col("allow_email").alias("allowEmail")]
    cfg = cfg or {}
    if cfg.get("nationality_field"):
        out.append(truthy("nationality").alias(cfg["nationality_field"]))
    for key, col in [("src_system", "src_system"), ("brand", "brand_tag"), ("country", "country"),
                     ("venue", "venue")]:
        field = (cfg.get("dimension_fields") or {}).get(key, "")
        if field:
            out.append(truthy(col).alias(field))
    return out


def build_payloads(queue: DataFrame, field_map: dict | None = None) -> DataFrame:
    """email, brand, JSON registration data with the brand's field names."""
    field_map = field_map or {}
    payload = None
    for b in C.BRANDS:
        js = F.to_json(F.struct(*_registration_fields(field_map.get(b))))
        payload = F.when(F.col("brand") == b, js) if payload is None else payload.when(F.col("brand") == b, js)
    payload = payload.otherwise(F.to_json(F.struct(*_registration_fields(None))))
    return queue.select("email", "brand", payload.alias("payload"))


def preview_payloads(master: DataFrame) -> DataFrame:
    """email, target brands, request wrapped as {customer, registrationData}."""
    targets = F.filter(_brands(), lambda b: F.array_contains(F.coalesce(F.col("tags"), F.array().cast(
        "array<string>")), b))
    reg = F.struct(*_registration_fields(None))
    req = F.to_json(F.struct(F.struct(F.col("email").alias("email")).alias("customer"),
                             reg.alias("registrationData")))
    return master.select("email", F.array_join(targets, ",").alias("brands"), req.alias("request"))


# ---------------------------------------------------------------------------
# Responses -> outcomes
# ---------------------------------------------------------------------------
def parse_body(raw: Column) -> Column:
    return F.from_json(raw, RESPONSE_SCHEMA)


def error_codes(parsed: Column) -> Column:
    """Sorted distinct codes of an error body (top level and causes)."""
    errs = F.coalesce(parsed["errors"], F.array())
    top = F.transform(errs, lambda e: e["code"])
    causes = F.flatten(F.transform(errs, lambda e: F.transform(
        F.coalesce(e["cause"], F.array()), lambda c: c["code"])))
    codes = F.filter(F.concat(top, causes), lambda x: x.isNotNull() & (x != ""))
    return F.when(parsed["status"] == "error", F.array_sort(F.array_distinct(codes))) \
        .otherwise(F.array().cast("array<string>"))


def _ascii_text(piece: Column) -> Column:
    """Characters beyond ASCII as ``\\uXXXX`` (pairs above the first plane)."""
    def unit(n):
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))

    def char(c):
        n = F.ascii(c).cast("long")
        low = n - 65536
        pair = F.concat(unit(F.lit(55296) + F.shiftright(low, 10)), unit(F.lit(56320) + low.bitwiseAND(F.lit(1023))))
        return F.when(n < 128, c).when(n < 65536, unit(n)).otherwise(pair)

    return F.when(piece.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(piece, ""), char), "")).otherwise(piece)


def json_dumps_text(raw: Column, ascii_only: bool = True) -> Column:
    """JSON text as Python's ``json.dumps`` prints it: a space after each
    separator outside strings, none elsewhere, and (by default) characters
    beyond ASCII escaped.  Numbers are taken as they are written."""
    pieces = F.regexp_extract_all(raw, F.lit(r'"(?:[^"\\]|\\.)*"|[^"]+'), F.lit(0))

    def one(p):
        text = F.replace(p, F.lit("\\/"), F.lit("/"))
        outside = F.regexp_replace(F.regexp_replace(p, r"\s+", ""), "([,:])", "$1 ")
        return F.when(p.startswith('"'), _ascii_text(text) if ascii_only else text).otherwise(outside)

    return F.array_join(F.transform(pieces, one), "")


def py_json_text(raw: Column, width: int) -> Column:
    """A response body as Python's ``json.dumps`` prints it, cut to ``width``;
    a missing body prints ``null``."""
    return F.substring(F.coalesce(json_dumps_text(raw), F.lit("null")), 1, width)


def tags_json(tags: Column, ascii_only: bool = True) -> Column:
    """A tag array as JSON text (``["A", "B"]``); NULL and empty give ``[]``."""
    return json_dumps_text(F.to_json(F.coalesce(tags, F.array().cast("array<string>"))), ascii_only)


def _raised(responses: DataFrame, body: str) -> Column:
    """Text of the call that raised instead of answering with ``body``."""
    if "error_text" not in responses.columns:
        return F.lit(None).cast("string")
    return F.when(F.col(body).isNull(), F.col("error_text"))


def py_tenth(x: Column) -> Column:
    """A non-negative double with one decimal as Python's ``.1f`` prints it:
    rounded from the exact binary value, ties to even."""
    scale = F.when(x < 2048, F.lit(2.0 ** 52)).otherwise(F.lit(2.0 ** 40))
    exact = (x * scale).cast("decimal(19,0)")          # a power of two: no rounding
    unit = scale.cast("decimal(17,0)")
    low = F.floor(x * 10).cast("long")
    low = F.when(low.cast("decimal(18,0)") * unit > exact * 10, low - 1).otherwise(low)
    twice = exact * 20 - low.cast("decimal(18,0)") * unit * 2   # fraction of a tenth, over 2 units
    up = (twice > unit) | ((twice == unit) & (low % 2 == 1))
    tenths = F.when(up, low + 1).otherwise(low)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def _ok(p: Column) -> Column:
    return F.coalesce(p["status"] == "ok", F.lit(False))


def _parsed(responses: DataFrame) -> DataFrame:
    return responses.withColumns({"_lk": parse_body(F.col("lookup_body")), "_cr": parse_body(F.col("create_body")),
                                  "_up": parse_body(F.col("update_body"))})


def _outcome(status: Column, detail: Column, member: Column) -> Column:
    return F.struct(status.alias("status"), detail.alias("detail"), member["comoMemberId"].alias("como_member_id"),
                    member["commonExtId"].alias("common_ext_id"))


def _create_outcome(responses: DataFrame) -> Column:
    lk, cr = F.col("_lk"), F.col("_cr")
    lk_codes, cr_codes = error_codes(lk), error_codes(cr)
    found = _ok(lk)
    not_found = F.array_contains(lk_codes, C.CODE_CUSTOMER_NOT_FOUND)
    exists = F.array_contains(cr_codes, C.CODE_ALREADY_EXISTS)
    status = (F.when(found, "exists").when(~not_found, "failed")
              .when(_ok(cr), "ok").when(exists, "exists").otherwise("failed"))
    detail = (F.when(found, F.lit(C.DETAIL_LEFT_ALONE))
              .when(~not_found, F.lit(C.DETAIL_NOT_CHECKED))
              .when(_ok(cr), F.lit(C.DETAIL_CREATED))
              .when(exists, F.lit(C.DETAIL_ALREADY))
              .otherwise(F.coalesce(_raised(responses, "create_body"), py_json_text(F.col("create_body"), 200))))
    return _outcome(status, detail, F.when(found, lk["membership"]).when(not_found & _ok(cr), cr["membership"]))


def _update_outcome(responses: DataFrame) -> Column:
    up, cr = F.col("_up"), F.col("_cr")
    up_codes, cr_codes = error_codes(up), error_codes(cr)
    not_found = F.array_contains(up_codes, C.CODE_CUSTOMER_NOT_FOUND)
    exists = F.array_contains(up_codes, C.CODE_ALREADY_EXISTS)
    cr_exists = F.array_contains(cr_codes, C.CODE_ALREADY_EXISTS)
    status = (F.when(_ok(up), "ok")
              .when(not_found & _ok(cr), "ok").when(not_found & cr_exists, "conflict").when(not_found, "failed")
              .when(exists, "conflict").otherwise("failed"))
    detail = (F.when(_ok(up), F.lit(C.DETAIL_UPDATED))
              .when(not_found & _ok(cr), F.lit(C.DETAIL_CREATED))
              .when(not_found, F.coalesce(_raised(responses, "create_body"), py_json_text(F.col("create_body"), 200)))
              .otherwise(F.coalesce(_raised(responses, "update_body"), py_json_text(F.col("update_body"), 200))))
    return _outcome(status, detail, F.when(~_ok(up) & not_found & _ok(cr), cr["membership"]))


def push_outcome_create(responses: DataFrame) -> DataFrame:
    """Lookup then create: exists / failed / ok / exists / failed.  A call
    that raised leaves its text (``error_text``) as the detail."""
    return _parsed(responses).select("email", "brand", _create_outcome(responses).alias("o")).select("email", "brand", "o.*")


def push_outcome_update(responses: DataFrame) -> DataFrame:
    """Update then create; not-found is checked before already-exists."""
    return _parsed(responses).select("email", "brand", _update_outcome(responses).alias("o")).select("email", "brand", "o.*")


def push_outcomes(responses: DataFrame) -> DataFrame:
    """Outcome per response row by its mode (create or update), in one pass;
    the attempt number stays where the log has one."""
    c, u = _create_outcome(responses), _update_outcome(responses)
    r = _parsed(responses)
    pick = F.when(F.col("mode") == "create", c).when(F.col("mode") == "update", u)
    return r.where(F.col("mode").isin("create", "update")).select(
        "email", "brand", *[x for x in ("attempt",) if x in responses.columns], pick.alias("o")).select(
        "email", "brand", *[x for x in ("attempt",) if x in responses.columns], "o.*")


def push_outcome_signup(responses: DataFrame, body_col: str = "create_body") -> DataFrame:
    """Signup push: ok / body mentions ``already exists`` / failed (detail cut to 300)."""
    p = parse_body(F.col(body_col))
    text = F.coalesce(F.col(body_col), F.lit("null"))
    status = F.when(_ok(p), "ok").when(text.contains("already exists"), "exists").otherwise("failed")
    raised = F.substring(_raised(responses, body_col), 1, 300)
    detail = F.when(_ok(p), F.lit(C.DETAIL_CREATED)).when(text.contains("already exists"), F.lit(C.DETAIL_ALREADY)) \
        .otherwise(F.coalesce(raised, py_json_text(F.col(body_col), 300)))
    return responses.select("email", *[x for x in ("attempt",) if x in responses.columns],
                            status.alias("como_status"), detail.alias("como_detail"))


def apply_signup_outcomes(signups: DataFrame, outcomes: DataFrame, run_ts: _dt.datetime = C.RUN_TS,
                          order_col: str = "attempt") -> DataFrame:
    """Write outcomes back onto the signup rows (by email): the last attempt's,
    so a signup row stays one row."""
    last = F.max_by(F.struct("como_status", "como_detail"), F.col(order_col))
    o = outcomes.groupBy("email").agg(last.alias("_o")).select(
        "email", F.col("_o.como_status").alias("_st"), F.col("_o.como_detail").alias("_dt"))
    j = signups.join(o, "email", "left")
    hit = F.col("_st").isNotNull()
    return (j.withColumn("como_status", F.when(hit, F.col("_st")).otherwise(F.col("como_status")))
             .withColumn("como_detail", F.when(hit, F.col("_dt")).otherwise(F.col("como_detail")))
             .withColumn("como_at", F.when(hit, ts_ntz(run_ts)).otherwise(F.col("como_at")))
             .drop("_st", "_dt"))


# ---------------------------------------------------------------------------
# State
# ---------------------------------------------------------------------------
STATE_COLUMNS = ["email", "brand", "status", "detail", "como_member_id", "common_ext_id", "last_pushed_at"]


def record_push_state(state: DataFrame, outcomes: DataFrame, run_ts: _dt.datetime = C.RUN_TS,
                      order_col: str | None = None) -> DataFrame:
    """Upsert on (email, brand): replace status and detail (cut to 500);
    never replace a held id with NULL.

    ``order_col`` names the attempt order of the log (default: ``attempt``; a
    log without that column must hold one row per key, else the job fails):
    status and detail come from the last attempt and each id from the last attempt that carried one,
    as writing the attempts one by one would leave them (one
    map-side-combined aggregate per key).
    """
    if order_col is None and "attempt" in outcomes.columns:
        order_col = "attempt"
    o_ = F.col(order_col) if order_col else F.lit(0)

    def last_id(c):
        return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o_)).alias(c)

    status = F.max_by("status", o_)
    if not order_col:
        twice = F.raise_error(F.lit("a key has several outcomes and the log has no attempt order"))
        status = F.when(F.count(F.lit(1)) > 1, twice.cast("string")).otherwise(status)
    outcomes = outcomes.groupBy("email", "brand").agg(
        status.alias("status"), F.max_by("detail", o_).alias("detail"),
        last_id("como_member_id"), last_id("common_ext_id"))
    o = outcomes.select("email", "brand", F.col("status").alias("_s"),
                        F.substring(F.coalesce(F.col("detail"), F.lit("")), 1, 500).alias("_d"),
                        F.col("como_member_id").alias("_m"), F.col("common_ext_id").alias("_x"),
                        F.lit(True).alias("_new"))
    j = state.join(o, ["email", "brand"], "full")
    new = F.coalesce(F.col("_new"), F.lit(False))
    return j.select("email", "brand",
                    F.when(new, F.col("_s")).otherwise(F.col("status")).alias("status"),
                    F.when(new, F.col("_d")).otherwise(F.col("detail")).alias("detail"),
                    F.coalesce(F.col("_m"), F.col("como_member_id")).alias("como_member_id"),
                    F.coalesce(F.col("_x"), F.col("common_ext_id")).alias("common_ext_id"),
                    F.when(new, ts_ntz(run_ts))
                    .otherwise(F.col("last_pushed_at").cast("timestamp_ntz")).alias("last_pushed_at"))


def clear_needs_push(master: DataFrame, state: DataFrame, brands=None) -> DataFrame:
    """needs_push becomes false where no configured brand tag lacks an ok
    push (rows without a brand tag are cleared vacuously)."""
    ok = state.where(F.col("status") == "ok").select("email", "brand")
    lacking = route_brands(master.where(F.col("needs_push")), brands).join(ok, ["email", "brand"], "left_anti") \
        .select("email").distinct().withColumn("_lacking", F.lit(True))
    j = master.join(lacking, "email", "left")
    return j.withColumn("needs_push", F.col("needs_push") & F.coalesce(F.col("_lacking"), F.lit(False))) \
        .drop("_lacking")


def clear_conflicts(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Delete (email, brand) rows so they are retried."""
    return state.join(keys.select("email", "brand"), ["email", "brand"], "left_anti")


def push_run_summary(outcomes: DataFrame) -> DataFrame:
    s = F.col("status")
    return outcomes.groupBy("brand").agg(
        F.count_if(s == "ok").cast("long").alias("created"),
        F.count_if(s == "exists").cast("long").alias("already_there"),
        F.count_if(s == "failed").cast("long").alias("failed"),
        F.count_if(s == "conflict").cast("long").alias("conflicts"))


def push_plan(master: DataFrame, state: DataFrame | None, brand: str = "ALL", rate: int = 0,
              batch_size: int = 0, batch_pause: int = 0) -> DataFrame:
    """One row: queued, api_calls, batches, seconds, human, rate, over_limit.

    queued = non-duplicate, brand-tagged, with no ok/exists push in any
    brand (0 when there is no state table).
    """
    brand = (brand or "ALL").upper()
    m = master.where(F.col("duplicate_of").isNull())
    if brand == "ALL":
        m = m.where(F.arrays_overlap(F.col("tags"), _brands()))
    else:
        m = m.where(F.array_contains(F.col("tags"), brand))
    if state is None:
        queued = master.sparkSession.range(1).select(F.lit(0).cast("long").alias("queued"))
    else:
        settled = state.where(F.col("status").isin("ok", "exists")).select("email")
        queued = m.join(settled, "email", "left_anti").agg(F.count(F.lit(1)).alias("queued"))
    per_call = 60.0 / max(rate, 1) if rate else C.PUSH_DEFAULT_DELAY
    q = F.col("queued")
    calls = F.floor(q * C.CALLS_PER_QUEUED).cast("long")
    batches = (F.when(q > 0, F.ceil(q / F.lit(batch_size))).otherwise(0).cast("long")
               if batch_size and batch_pause else F.lit(0).cast("long"))
    seconds = calls * per_call + (F.greatest(batches - 1, F.lit(0)) * batch_pause
                                  if batch_size and batch_pause else F.lit(0.0))
    human = (F.when(seconds < 60, F.concat(F.floor(seconds).cast("long").cast("string"), F.lit(" sec")))
             .when(seconds < 3600, F.concat(F.bround(seconds / 60, 0).cast("long").cast("string"), F.lit(" min")))
             .otherwise(F.concat(py_tenth(seconds / 3600.0), F.lit(" hours"))))
    return queued.select(
        q.alias("queued"), calls.alias("api_calls"), batches.alias("batches"),
        F.floor(seconds).cast("long").alias("seconds"), human.alias("human"),
        F.lit(rate or int(60 / per_call)).cast("long").alias("rate"),
        F.lit(bool(rate and rate > C.PUSH_RATE_LIMIT)).alias("over_limit"))


# ---------------------------------------------------------------------------
# Export and lookup
# ---------------------------------------------------------------------------
def export_members(master: DataFrame, brand: str | None = None) -> DataFrame:
    """Rows of the import template (all rows, or one brand), ordered by email."""
    m = master if not brand else master.where(F.array_contains(F.col("tags"), brand.upper()))
    tag_json = tags_json(F.col("tags"))
    h = C.EXPORT_HEADINGS
    return m.orderBy("email").select(
        F.col("email").alias(h[0]), F.coalesce("first_name", F.lit("")).alias(h[1]),
        F.coalesce("last_name", F.lit("")).alias(h[2]), F.coalesce("nationality", F.lit("")).alias(h[3]),
        F.coalesce(F.date_format("birthday", "dd.MM.yyyy"), F.lit("")).alias(h[4]),
        tag_json.alias(h[5]),
        F.when(F.col("allow_email").isNull(), F.lit("")).otherwise(
            F.lower(F.col("allow_email").cast("string"))).alias(h[6]))


def write_export_csv(export: DataFrame, path: str) -> None:
    """CSV with a header, CRLF line ends and doubled quotes.

    Written in parallel: the export is range-partitioned by email, so the
    part files are in email order and each starts with the heading row.
    """
    (export.write.mode("overwrite")
     .option("header", True).option("lineSep", "\r\n").option("escape", '"')
     .option("emptyValue", "").csv(path))


def customer_360(emails: DataFrame, master: DataFrame, sources: dict[str, DataFrame],
                 state: DataFrame | None) -> DataFrame:
    """One row per looked-up email: master fields and per-table row counts.

    Source tables are cut to the asked-for addresses, then pre-aggregated by
    lower(email), so a hot address costs one row per table, not its raw rows.
    """
    e = emails.select(F.lower(F.trim(F.col("email"))).alias("email")).distinct()
    out = e.join(master.select("email", F.lit(True).alias("in_master"), "first_name", "last_name",
                               F.array_join("tags", ",").alias("tags")), "email", "left")
    for name, df in sources.items():
        asked = e.select(F.col("email").alias("_asked"))
        mine = df.join(asked, F.lower(F.col("email")) == F.col("_asked"), "left_semi")
        counts = mine.groupBy(F.lower(F.col("email")).alias("email")) \
            .agg(F.count(F.lit(1)).alias(f"{name}_rows"))
        out = out.join(counts, "email", "left").withColumn(
            f"{name}_rows", F.coalesce(F.col(f"{name}_rows"), F.lit(0)).cast("long"))
    if state is not None:
        mine = state.join(e, "email", "left_semi")
        counts = mine.groupBy("email").agg(F.count(F.lit(1)).alias("push_rows"),
                                            F.array_join(F.array_sort(F.collect_set("brand")), ",")
                                            .alias("push_brands"))
        out = out.join(counts, "email", "left").withColumn(
            "push_rows", F.coalesce(F.col("push_rows"), F.lit(0)).cast("long"))
    return out.withColumn("in_master", F.coalesce(F.col("in_master"), F.lit(False)))


def customer_rows(emails: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows behind each looked-up address, in long form: ``email, table,
    row`` (the row as JSON text).  Tables are first cut to the asked-for
    addresses, then turned into text; a hot address gives many rows, never an
    array."""
    e = emails.select(F.lower(F.trim(F.col("email"))).alias("_asked")).distinct()
    out = None
    for name, df in tables.items():
        mine = df.join(e, F.lower(F.col("email")) == F.col("_asked"), "left_semi")
        part = mine.select(F.lower(F.col("email")).alias("email"), F.lit(name).alias("table"),
                           F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
        out = part if out is None else out.unionByName(part)
    return out
