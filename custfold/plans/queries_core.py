"""Registered queries: cleansing passes and the master build."""

from __future__ import annotations

import datetime as _dt_mod

from pyspark.sql import functions as F

from custfold import config as C
from custfold.catalog import master_view, register
from custfold.functions import email as E
from custfold.functions import text as T
from custfold.functions.sql import register_rules
from custfold.operators import ingest, master as M
from custfold.oracle import duck as D
from custfold.plans import pipeline
from custfold.sources.fixtures import fixture

# ---------------------------------------------------------------------------
# Master build
# ---------------------------------------------------------------------------


@register("rebuild_pipeline", D.with_ctes(["master"], f"SELECT {D.master_cols()} FROM master"))
def q_rebuild_pipeline(spark, sf):
    return master_view(pipeline.master_table(spark, sf))


@register("refresh_master", D.with_ctes(["master_inc"], f"SELECT {D.master_cols()} FROM master_inc"))
def q_refresh_master(spark, sf):
    return master_view(pipeline.master_table(spark, sf, with_prior=True))


@register("refresh_master_keyed", D.with_ctes(["master_inc"], f"SELECT {D.master_cols()} FROM master_inc"))
def q_refresh_master_keyed(spark, sf):
    """A refresh over a prior master stored by address, which is not shuffled."""
    rb = M.rebuild_pipeline(pipeline.stored_sources(spark, sf), prior=pipeline.keyed_prior(spark, sf), keyed_prior=True)
    return master_view(rb.master)


@register("merge_sources", D.with_ctes(["merged_full"], """
SELECT email, first_name, last_name, nationality, birthday, allow_email,
  array_to_string(tags, ',') AS tags, array_to_string(sources, ',') AS sources FROM merged_full"""))
def q_merge_sources(spark, sf):
    m = M.merge_sources(pipeline.stored_sources(spark, sf)).master
    return m.select("email", "first_name", "last_name", "nationality", "birthday", "allow_email",
                    F.array_join("tags", ",").alias("tags"), F.array_join("sources", ",").alias("sources"))


@register("merge_tags", D.with_ctes(["merged_full"], """
SELECT email, array_to_string(tags, ',') AS tags FROM merged_full"""))
def q_merge_tags(spark, sf):
    m = M.merge_sources(pipeline.stored_sources(spark, sf)).master
    return m.select("email", F.array_join("tags", ",").alias("tags"))


@register("merge_source_labels", D.with_ctes(["merged_full"], """
SELECT email, array_to_string(sources, ',') AS sources FROM merged_full"""))
def q_merge_source_labels(spark, sf):
    m = M.merge_sources(pipeline.stored_sources(spark, sf)).master
    return m.select("email", F.array_join("sources", ",").alias("sources"))


# A source row counts when it inserts (nothing before it) or gains a field,
# a tag, or (always, for a new source label) its label.  Without a prior
# master every source label is new, so every kept row counts.
_COUNTS_FULL = D.with_ctes(["canon_one"], """
SELECT src AS source, CAST(count(*) AS BIGINT) AS rows_merged, rnk - 1 AS merge_order
FROM canon_one GROUP BY src, rnk""")


@register("refresh_counts", _COUNTS_FULL)
def q_refresh_counts(spark, sf):
    return M.refresh_counts(M.merge_sources(pipeline.stored_sources(spark, sf)))


_COUNTS_INC = D.with_ctes(["canon_one", "prior_master"], """
SELECT source, CAST(count(*) FILTER (WHERE applied) AS BIGINT) AS rows_merged, merge_order FROM (
  SELECT c.src AS source, c.rnk - 1 AS merge_order,
    (p.email IS NULL AND b.n_before = 0)
    OR (coalesce(p.first_name, b.fn) IS NULL AND c.first_name IS NOT NULL)
    OR (coalesce(p.last_name, b.ln) IS NULL AND c.last_name IS NOT NULL)
    OR (coalesce(p.birthday, b.bd) IS NULL AND c.birthday IS NOT NULL)
    OR (coalesce(p.allow_email, b.ae) IS NULL AND c.allow_email IS NOT NULL)
    OR len(list_filter(c.tags, lambda t: NOT list_contains(
         coalesce(p.tags, []::VARCHAR[]) || coalesce(b.tg, []::VARCHAR[]), t))) > 0
    OR NOT list_contains(coalesce(p.sources, []::VARCHAR[]), c.src) AS applied
  FROM canon_one c
  JOIN (SELECT c2.email, c2.rnk, count(e.email) AS n_before,
          arg_min(e.first_name, e.rnk) FILTER (WHERE e.first_name IS NOT NULL) AS fn,
          arg_min(e.last_name, e.rnk) FILTER (WHERE e.last_name IS NOT NULL) AS ln,
          arg_min(e.birthday, e.rnk) FILTER (WHERE e.birthday IS NOT NULL) AS bd,
          bool_or(e.allow_email) AS ae,
          flatten(list(e.tags) FILTER (WHERE e.tags IS NOT NULL)) AS tg
        FROM canon_one c2 LEFT JOIN canon_one e ON e.email = c2.email AND e.rnk < c2.rnk
        GROUP BY c2.email, c2.rnk) b ON b.email = c.email AND b.rnk = c.rnk
  LEFT JOIN prior_master p ON p.email = c.email
) q GROUP BY source, merge_order""")


@register("refresh_counts_incremental", _COUNTS_INC)
def q_refresh_counts_inc(spark, sf):
    prior = fixture(spark, sf, "prior_master")
    return M.refresh_counts(M.merge_sources(pipeline.stored_sources(spark, sf), prior=prior))


@register("refresh_counts_keyed", _COUNTS_INC)
def q_refresh_counts_keyed(spark, sf):
    return M.refresh_counts(M.merge_sources(pipeline.stored_sources(spark, sf), prior=pipeline.keyed_prior(spark, sf), keyed_prior=True))


@register("refresh_changed", D.with_ctes(["merged_inc"], """
SELECT email, CASE WHEN change = 'inserted' THEN true ELSE needs_push END AS needs_push, change
FROM merged_inc"""))
def q_refresh_changed(spark, sf):
    prior = fixture(spark, sf, "prior_master")
    return M.refresh_changed(M.merge_sources(pipeline.stored_sources(spark, sf), prior=prior))


@register("record_minors", D.with_ctes(["minor_ledger"], "SELECT email, source_table FROM minor_ledger"))
def q_record_minors(spark, sf):
    full, _new = M.record_minors(pipeline.stored_sources(spark, sf))
    return full.select("email", "source_table")


@register("purge_minors", D.with_ctes(["merged_inc"], f"""
SELECT email, birthday FROM merged_inc WHERE NOT {D.adult('birthday')}"""))
def q_purge_minors(spark, sf):
    prior = fixture(spark, sf, "prior_master")
    res = M.merge_sources(pipeline.stored_sources(spark, sf), prior=prior)
    _kept, removed = M.purge_minors(res.master)
    return removed.select("email", "birthday")


@register("split_dimensions", D.with_ctes(["master"], """
SELECT email, src_system, brand, country, venue FROM master"""))
def q_split_dimensions(spark, sf):
    return pipeline.stored_master(spark, sf).select("email", "src_system", "brand", "country", "venue")


@register("dimension_counts", D.with_ctes(["master"], """
SELECT CAST(count(*) FILTER (WHERE brand IS NOT NULL) AS BIGINT) AS with_brand,
       CAST(count(*) FILTER (WHERE venue IS NOT NULL) AS BIGINT) AS with_venue FROM master"""))
def q_dimension_counts(spark, sf):
    return M.dimension_counts(pipeline.stored_master(spark, sf))


@register("find_duplicates", D.with_ctes(["master"], """
SELECT email, email_key, duplicate_of, dup_reason, needs_push FROM master"""))
def q_find_duplicates(spark, sf):
    return pipeline.stored_master(spark, sf).select("email", "email_key", "duplicate_of", "dup_reason",
                                                   "needs_push")


@register("duplicate_counts", D.with_ctes(["master"], """
SELECT CAST(count(*) FILTER (WHERE duplicate_of IS NOT NULL) AS BIGINT) AS duplicates,
       CAST(count(DISTINCT email_key) FILTER (WHERE duplicate_of IS NOT NULL) AS BIGINT) AS people_affected
FROM master"""))
def q_duplicate_counts(spark, sf):
    return M.duplicate_counts(pipeline.stored_master(spark, sf))


@register("possible_duplicates", D.with_ctes(["master"], """
SELECT lower(trim(first_name)) AS first_name, lower(trim(last_name)) AS last_name, birthday,
  CAST(count(*) AS BIGINT) AS records, min(email) AS first_email
FROM master WHERE duplicate_of IS NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
GROUP BY 1, 2, 3 HAVING count(*) > 1"""))
def q_possible_duplicates(spark, sf):
    return M.possible_duplicates(pipeline.stored_master(spark, sf))


@register("possible_duplicate_members", D.with_ctes(["master"], """
SELECT g.first_name, g.last_name, g.birthday, g.records, m.email FROM (
  SELECT lower(trim(first_name)) AS first_name, lower(trim(last_name)) AS last_name, birthday,
    CAST(count(*) AS BIGINT) AS records
  FROM master WHERE duplicate_of IS NULL AND first_name IS NOT NULL AND last_name IS NOT NULL
  GROUP BY 1, 2, 3 HAVING count(*) > 1) g
JOIN master m ON m.duplicate_of IS NULL AND m.first_name IS NOT NULL AND m.last_name IS NOT NULL
  AND lower(trim(m.first_name)) = g.first_name AND lower(trim(m.last_name)) = g.last_name
  AND m.birthday IS NOT DISTINCT FROM g.birthday"""))
def q_possible_duplicate_members(spark, sf):
    return M.possible_duplicate_members(pipeline.stored_master(spark, sf))


# ---------------------------------------------------------------------------
# Cleansing passes over the wi-fi table (each a whole-table column pass)
# ---------------------------------------------------------------------------
def _wifi(spark, sf):
    return fixture(spark, sf, "wifi_guests")


_FIX = ("CASE WHEN email IS NULL OR position('@' IN email) = 0 THEN email "
        "ELSE split_part(lower(trim(email)), '@', 1) || '@' || "
        "coalesce(dc.correct, split_part(lower(trim(email)), '@', 2)) END")


@register("correct_domains", D.with_ctes(["wifi_guests", "domain_corrections"], f"""
SELECT w.doc_id, {_FIX} AS email FROM wifi_guests w
LEFT JOIN domain_corrections dc ON dc.wrong = split_part(lower(trim(w.email)), '@', 2)"""))
def q_correct_domains(spark, sf):
    return _wifi(spark, sf).select("doc_id", E.fix_domain(F.col("email")).alias("email"))


@register("valid_addresses", D.with_ctes(["wifi_guests", "domain_corrections"], f"""
SELECT doc_id, e1 AS email FROM (
  SELECT w.doc_id, {_FIX} AS e1 FROM wifi_guests w
  LEFT JOIN domain_corrections dc ON dc.wrong = split_part(lower(trim(w.email)), '@', 2)) q
WHERE e1 IS NOT NULL AND trim(e1) <> '' AND regexp_matches(e1, {D.EMAIL_RE})
  AND NOT regexp_matches(split_part(e1, '@', 1), '^[0-9]+$')"""))
def q_valid_addresses(spark, sf):
    w = _wifi(spark, sf).select("doc_id", E.fix_domain(F.col("email")).alias("email"))
    return w.where(E.is_valid_address(F.col("email")))


@register("drop_blocked_domains", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, email FROM wifi_guests
WHERE email IS NOT NULL AND lower(split_part(email, '@', 2)) NOT IN {D._in_list(C.BLOCKED_DOMAINS)}"""))
def q_drop_blocked_domains(spark, sf):
    w = _wifi(spark, sf).where(F.col("email").isNotNull())
    return w.where(~E.is_blocked_domain(F.col("email"))).select("doc_id", "email")


@register("clean_names", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, {D.clean_name('fname')} AS first_name, {D.clean_name('lname')} AS last_name FROM wifi_guests"""))
def q_clean_names(spark, sf):
    return _wifi(spark, sf).select("doc_id", T.clean_name("fname").alias("first_name"),
                                   T.clean_name("lname").alias("last_name"))


@register("clean_nationality", D.with_ctes(["prior_master"], """
SELECT email, nullif(trim(nationality), '') AS nationality FROM prior_master"""))
def q_clean_nationality(spark, sf):
    return fixture(spark, sf, "prior_master").select("email", T.clean_nationality("nationality").alias("nationality"))


@register("parse_birthdays", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, {D.WIFI_BDAY} AS birthday FROM wifi_guests"""))
def q_parse_birthdays(spark, sf):
    return _wifi(spark, sf).select("doc_id", T.parse_birthday("dob").alias("birthday"))


@register("plausible_birthdays", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, {D.clean_birthday('b')} AS birthday FROM (SELECT doc_id, {D.WIFI_BDAY} AS b FROM wifi_guests) q"""))
def q_plausible_birthdays(spark, sf):
    return _wifi(spark, sf).select("doc_id", T.clean_birthday(T.parse_birthday("dob")).alias("birthday"))


@register("adult_gate", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id FROM (SELECT doc_id, {D.WIFI_BDAY} AS b FROM wifi_guests) q WHERE b IS NULL OR {D.adult('b')}"""))
def q_adult_gate(spark, sf):
    b = T.parse_birthday("dob")
    return _wifi(spark, sf).where(b.isNull() | T.is_adult(b)).select("doc_id")


@register("parse_markets", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, array_to_string({D.market_tags('lastmarket')}, ',') AS market_tags,
  CAST(len({D.market_tags('lastmarket')}) AS BIGINT) AS n_tags FROM wifi_guests"""))
def q_parse_markets(spark, sf):
    t = T.parse_market("lastmarket")
    return _wifi(spark, sf).select("doc_id", F.array_join(t, ",").alias("market_tags"),
                                   F.size(t).cast("long").alias("n_tags"))


@register("clean_tags", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, array_to_string({D.clean_tags("['wifi', ' Wifi '] || " + D.market_tags('lastmarket') + " || [lower(lname)]")}, ',') AS tags
FROM wifi_guests"""))
def q_clean_tags(spark, sf):
    raw = F.concat(F.array(F.lit("wifi"), F.lit(" Wifi ")), T.parse_market("lastmarket"),
                   F.array(F.lower("lname")))
    return _wifi(spark, sf).select("doc_id", F.array_join(T.clean_tags(raw), ",").alias("tags"))


@register("inbox_key", D.with_ctes(["wifi_guests"], f"""
SELECT doc_id, {D.inbox_key('email')} AS email_key FROM wifi_guests"""))
def q_inbox_key(spark, sf):
    return _wifi(spark, sf).select("doc_id", E.inbox_key(F.col("email")).alias("email_key"))


@register("registry_project", D.with_ctes(["canon"], """
SELECT email, src AS source, pk, first_name, last_name, birthday, array_to_string(tags, ',') AS tags
FROM canon"""))
def q_registry_project(spark, sf):
    src = pipeline.stored_sources(spark, sf)
    out = None
    for spec in C.ordered_specs():
        p = M.registry_project(src[spec.source_table], spec).select(
            "email", F.lit(spec.source_table).alias("source"), F.col("_pk").alias("pk"),
            "first_name", "last_name", "birthday", F.array_join("tags", ",").alias("tags"))
        out = p if out is None else out.unionByName(p)
    return out


def _registry(spark, sf):
    """A stored registry: the default sources in another order, a disabled one and
    one whose table does not exist."""
    off = C.SourceSpec(source_table="wifi_archive", email_expr="upper(email)", source_tag="OLD", priority=1, enabled=False)
    gone = C.SourceSpec(source_table="loyalty_app", email_expr="mail", source_tag="APP", priority=15)
    return pipeline.stored(spark, sf, "source_map", lambda: M.registry_table(spark, [gone, *reversed(C.DEFAULT_REGISTRY), off]))


@register("registry_from_table", D.with_ctes(["merged_full"], """
SELECT email, first_name, last_name, nationality, birthday, allow_email,
  array_to_string(tags, ',') AS tags, array_to_string(sources, ',') AS sources FROM merged_full"""))
def q_registry_from_table(spark, sf):
    """The merge by a registry read from a table."""
    src = pipeline.stored_sources(spark, sf)
    m = M.merge_sources({**src, "wifi_archive": src["wifi_guests"]}, registry=M.specs_from_table(_registry(spark, sf))).master
    return m.select("email", "first_name", "last_name", "nationality", "birthday", "allow_email",
                    F.array_join("tags", ",").alias("tags"), F.array_join("sources", ",").alias("sources"))


@register("registry_counts_from_table", D.with_ctes(["canon_one"], """
SELECT src AS source, CAST(count(*) AS BIGINT) AS rows_merged, rnk - 1 + CASE WHEN src = 'revel_customers' THEN 1 ELSE 0 END AS merge_order
FROM canon_one GROUP BY src, rnk UNION ALL SELECT 'loyalty_app', -1, 2"""))
def q_registry_counts_from_table(spark, sf):
    """Rows per source of that registry; -1 for the missing table."""
    return M.refresh_counts(M.merge_sources(pipeline.stored_sources(spark, sf), registry=M.specs_from_table(_registry(spark, sf))))


@register("sql_rules", D.with_ctes(["wifi_guests", "domain_corrections"], f"""
SELECT w.doc_id, {_FIX} AS fixed, coalesce(regexp_matches({_FIX}, {D.EMAIL_RE}) AND NOT regexp_matches(split_part({_FIX}, '@', 1), '^[0-9]+$'), false) AS valid,
  coalesce(lower(split_part(email, '@', 2)) IN {D._in_list(C.BLOCKED_DOMAINS)}, false) AS blocked, {D.clean_name('fname')} AS first_name,
  {D.WIFI_BDAY} AS parsed, {D.clean_birthday(D.WIFI_BDAY)} AS birthday, {D.WIFI_BDAY} IS NULL OR {D.adult(D.WIFI_BDAY)} AS adult,
  array_to_string({D.market_tags('lastmarket')}, ',') AS market,
  array_to_string({D.clean_tags("['wifi', ' Wifi '] || " + D.market_tags('lastmarket') + " || [lower(lname)]")}, ',') AS tags,
  {D.inbox_key('email')} AS inbox, nullif(trim(lname), '') AS nationality
FROM wifi_guests w LEFT JOIN domain_corrections dc ON dc.wrong = split_part(lower(trim(w.email)), '@', 2)"""))
def q_sql_rules(spark, sf):
    """The scalar rules called as SQL functions."""
    register_rules(spark)
    return _wifi(spark, sf).selectExpr(
        "doc_id", "fix_domain(email) AS fixed", "is_valid_address(fix_domain(email)) AS valid", "is_blocked_domain(email) AS blocked",
        "clean_name(fname) AS first_name", "parse_birthday(dob) AS parsed", "plausible_birthday(parse_birthday(dob)) AS birthday",
        "is_adult(parse_birthday(dob)) AS adult", "array_join(parse_market(lastmarket), ',') AS market",
        "array_join(clean_tags(concat(array('wifi', ' Wifi '), parse_market(lastmarket), array(lower(lname)))), ',') AS tags",
        "inbox_key(email) AS inbox", "clean_nationality(lname) AS nationality")


@register("dedupe_within_source", D.with_ctes(["canon_one"], """
SELECT email, src AS source, pk FROM canon_one"""))
def q_dedupe_within_source(spark, sf):
    src = pipeline.stored_sources(spark, sf)
    out = None
    for spec in C.ordered_specs():
        p = M.dedupe_within_source(M.registry_project(src[spec.source_table], spec)).select(
            "email", F.lit(spec.source_table).alias("source"), F.col("_pk").alias("pk"))
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# Email classification (point-of-sale feed)
# ---------------------------------------------------------------------------
@register("classify_email", D.with_ctes(["revel_typed"], """
SELECT _seq, email, email_reason IS NULL AS email_ok, email_reason FROM revel_typed"""))
def q_classify_email(spark, sf):
    raw = fixture(spark, sf, "revel_raw").select("_seq", "email")
    return E.with_email_check(raw, "email").select("_seq", "email", "email_ok", "email_reason")


@register("gibberish_score", D.with_ctes(["revel_g2"], f"""
SELECT _seq, g_word AS word, CAST({D.gib_score('g_sig')} AS INTEGER) AS score,
  array_to_string(g_sig, ',') AS signals FROM revel_g2"""))
def q_gibberish_score(spark, sf):
    raw = fixture(spark, sf, "revel_raw").select(
        "_seq", F.substring_index(F.lower(E.py_strip(F.col("email"))), "@", 1).alias("local"))
    g = E.with_gibberish(raw, "local")
    return g.select("_seq", E.gibberish_word(F.col("local")).alias("word"),
                    F.col("gibberish_score").alias("score"),
                    F.array_join("gibberish_signals", ",").alias("signals"))


@register("email_check_sample", D.with_ctes(["revel_typed"], """
SELECT _seq, email, CASE WHEN email_reason IS NULL THEN 'keep' ELSE 'drop' END AS verdict, email_reason
FROM revel_typed ORDER BY _seq LIMIT 15"""))
def q_email_check_sample(spark, sf):
    first = fixture(spark, sf, "revel_raw").select("_seq", "email").orderBy("_seq").limit(15)  # the report's rows
    return E.with_email_check(first, "email").select(
        "_seq", "email", F.when(F.col("email_ok"), "keep").otherwise("drop").alias("verdict"), "email_reason")


@register("ingest_pos_customers", D.with_ctes(["revel_typed"], """
SELECT revel_id, brand, first_name, last_name, email, email_reason IS NULL AS email_ok, email_opt_in,
  CAST(updated_date AS VARCHAR) AS updated_date, email_reason, _seq
FROM revel_typed WHERE revel_id IS NOT NULL AND revel_id <> ''"""))
def q_ingest_pos(spark, sf):
    t = ingest.ingest_pos_customers(fixture(spark, sf, "revel_raw")).drop("email_reason_pre")
    return t.withColumn("updated_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss"))


@register("upsert_pos_customers", D.with_ctes(["revel_customers"], """
SELECT revel_id, brand, first_name, last_name, email, email_ok, email_opt_in,
  CAST(updated_date AS VARCHAR) AS updated_date, email_reason FROM revel_customers"""))
def q_upsert_pos(spark, sf):
    t = ingest.revel_customers(fixture(spark, sf, "revel_raw"))
    return t.withColumn("updated_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss")).drop("updated_at")


@register("discard_rejects", D.with_ctes(["revel_typed"], f"""
SELECT revel_id, _seq, email, email_reason FROM revel_typed
WHERE split_part(email_reason, ':', 1) IN {D._in_list(C.DISCARD_REASONS)}"""))
def q_discard_rejects(spark, sf):
    _kept, gone = ingest.discard_rejects(ingest.ingest_pos_customers(fixture(spark, sf, "revel_raw")))
    return gone.select("revel_id", "_seq", "email", "email_reason")


@register("pos_write_stats", D.with_ctes(["revel_typed"], f"""
SELECT 'outcome' AS kind, reason, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN split_part(email_reason, ':', 1) IN {D._in_list(C.DISCARD_REASONS)} THEN 'discarded'
              WHEN email_reason IS NULL THEN 'ok' ELSE 'rejected' END AS reason
  FROM revel_typed WHERE revel_id IS NOT NULL AND revel_id <> '') q GROUP BY reason
UNION ALL
SELECT 'reason', split_part(email_reason, ':', 1), CAST(count(*) AS BIGINT) FROM revel_typed
WHERE revel_id IS NOT NULL AND revel_id <> '' AND email_reason IS NOT NULL
  AND split_part(email_reason, ':', 1) NOT IN {D._in_list(C.DISCARD_REASONS)}
GROUP BY 2"""))
def q_pos_write_stats(spark, sf):
    return ingest.pos_write_stats(fixture(spark, sf, "revel_raw"))


# ---------------------------------------------------------------------------
# Newsletter signups
# ---------------------------------------------------------------------------
@register("accept_signups", D.with_ctes(["signup_checked"], """
SELECT seq, email, brand, country, site, page, first_name, last_name, reject_reason FROM signup_checked"""))
def q_accept_signups(spark, sf):
    return ingest.accept_signups(fixture(spark, sf, "signup_events")).drop("ts")


@register("upsert_signups", D.with_ctes(["newsletter_signups"], """
SELECT email, brand, country, src_system, site, page, first_name, last_name,
  strftime(signed_up_at, '%Y-%m-%d %H:%M:%S.%f') AS signed_up_at FROM newsletter_signups"""))
def q_upsert_signups(spark, sf):
    n = ingest.newsletter_signups(fixture(spark, sf, "signup_events"))
    return n.select("email", "brand", "country", "src_system", "site", "page", "first_name", "last_name",
                    F.date_format("signed_up_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("signed_up_at"))


# ---------------------------------------------------------------------------
# Registry with a table that does not exist, rebuild metrics, two batches
# ---------------------------------------------------------------------------
_ABSENT = C.SourceSpec(source_table="loyalty_cards", email_expr="email", source_tag="LOYALTY", priority=30)


@register("refresh_counts_missing_table", D.with_ctes(["canon_one"], """
SELECT src AS source, CAST(count(*) AS BIGINT) AS rows_merged, rnk - 1 AS merge_order
FROM canon_one GROUP BY src, rnk
UNION ALL SELECT 'loyalty_cards', CAST(-1 AS BIGINT), 3"""))
def q_refresh_counts_missing(spark, sf):
    src = dict(pipeline.stored_sources(spark, sf), loyalty_cards=None)
    res = M.merge_sources(src, registry=C.DEFAULT_REGISTRY + [_ABSENT])
    return M.refresh_counts(res)


@register("rebuild_metrics", D.with_ctes(["minor_ledger", "merged_inc", "master_inc"], f"""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM minor_ledger) AS newly_excluded,
  (SELECT CAST(count(*) AS BIGINT) FROM merged_inc WHERE NOT {D.adult('birthday')}) AS removed_from_master,
  CAST(count(*) FILTER (WHERE brand IS NOT NULL) AS BIGINT) AS with_brand,
  CAST(count(*) FILTER (WHERE venue IS NOT NULL) AS BIGINT) AS with_venue,
  CAST(count(*) FILTER (WHERE duplicate_of IS NOT NULL) AS BIGINT) AS duplicates,
  CAST(count(DISTINCT email_key) FILTER (WHERE duplicate_of IS NOT NULL) AS BIGINT) AS people_affected
FROM master_inc"""))
def q_rebuild_metrics(spark, sf):
    rb = pipeline.rebuild(spark, sf, with_prior=True)
    return M.rebuild_metrics(rb)


def _typed_batches_sql():
    return f"""
SELECT revel_id, brand, first_name, last_name, email, email_ok, email_opt_in,
  CAST(updated_date AS VARCHAR) AS updated_date, email_reason,
  strftime(CASE WHEN b = 1 THEN {D.RUN_TS} ELSE {D.RUN_TS} - INTERVAL 1 DAY END, '%Y-%m-%d %H:%M:%S') AS updated_at
FROM (SELECT k.*, CASE WHEN r.updated_date < '1995' THEN 0 ELSE 1 END AS b,
        row_number() OVER (PARTITION BY k.revel_id ORDER BY CASE WHEN r.updated_date < '1995' THEN 0 ELSE 1 END DESC,
                           k._seq DESC) AS rn
      FROM revel_kept k JOIN revel_raw r ON r._seq = k._seq) q
WHERE rn = 1"""


@register("upsert_pos_incremental", D.with_ctes(["revel_kept", "revel_raw"], _typed_batches_sql()))
def q_upsert_pos_incremental(spark, sf):
    raw = fixture(spark, sf, "revel_raw")
    first = ingest.revel_customers(raw.where(F.col("updated_date") < "1995"),
                                   run_ts=C.RUN_TS - _dt_mod.timedelta(days=1))
    second = ingest.revel_customers(raw.where(~F.coalesce(F.col("updated_date") < "1995", F.lit(False))),
                                    existing=first)
    return second.withColumn("updated_date", F.date_format("updated_date", "yyyy-MM-dd HH:mm:ss")) \
        .withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@register("rebuild_strict_minors", D.with_ctes(["master_strict"], f"SELECT {D.master_cols()} FROM master_strict"))
def q_rebuild_strict_minors(spark, sf):
    rb = M.rebuild_pipeline(pipeline.stored_sources(spark, sf), strict_minors=True)
    return master_view(rb.master)


# A ledger left by a run twelve years earlier (when the youngest birthdays
# were still in the future, so not recorded); this run adds only new
# addresses and keeps every earlier entry, also of people who are adults now.
_EARLIER = _dt_mod.date(C.AS_OF.year - 12, C.AS_OF.month, C.AS_OF.day)
_EARLIER_TS = _dt_mod.datetime(_EARLIER.year, _EARLIER.month, _EARLIER.day)


@register("record_minors_incremental", D.with_ctes(["wifi_guests"], f"""
, b AS (SELECT lower(trim(email)) AS email, {D.WIFI_BDAY} AS d FROM wifi_guests
           WHERE email IS NOT NULL AND trim(email) <> ''),
prior AS (SELECT DISTINCT email FROM b WHERE d IS NOT NULL AND NOT {D.adult_at('d', _EARLIER)}),
now_ AS (SELECT DISTINCT email FROM b WHERE d IS NOT NULL AND NOT {D.adult('d')})
SELECT email, 'wifi_guests' AS source_table, '{_EARLIER_TS.isoformat(sep=' ')}' AS excluded_at FROM prior
UNION ALL
SELECT email, 'wifi_guests', '{C.RUN_TS.isoformat(sep=' ')}' FROM now_ WHERE email NOT IN (SELECT email FROM prior)"""))
def q_record_minors_incremental(spark, sf):
    src = pipeline.stored_sources(spark, sf)
    prior, _ = M.record_minors(src, as_of=_EARLIER, run_ts=_EARLIER_TS)
    full, _new = M.record_minors(src, ledger=prior)
    return full.select("email", "source_table",
                       F.date_format("excluded_at", "yyyy-MM-dd HH:mm:ss").alias("excluded_at"))
