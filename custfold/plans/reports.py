"""Reports: each is one DataFrame function over stored tables.

Reports sharing a scan are single ``agg`` calls with ``count_if`` (one pass,
partial aggregation); top-k lists carry key columns as tie-breaks so the
order is total; brand-level reports explode the tag array against the
fixed brand list (a bounded literal, no join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.email import reason_class
from custfold.operators.activate import tags_json


def _cnt(cond) -> F.Column:
    return F.count_if(F.coalesce(cond, F.lit(False))).cast("long")


def _brand_tags(tags_col="tags") -> F.Column:
    return F.array_intersect(F.col(tags_col), F.array(*[F.lit(b) for b in C.BRANDS]))


def json_array_text(arr) -> F.Column:
    """Tags as a JSON array with a space after each comma (``["A", "B"]``)."""
    return tags_json(F.col(arr) if isinstance(arr, str) else arr, ascii_only=False)


# ---------------------------------------------------------------------------
# Point-of-sale and wi-fi sources
# ---------------------------------------------------------------------------
def pos_by_brand(pos: DataFrame) -> DataFrame:
    return pos.groupBy("brand").agg(F.count(F.lit(1)).alias("total"), _cnt(F.col("email_ok")).alias("usable"),
                                    _cnt(F.col("email_opt_in")).alias("opted_in"))


def pos_rejections(pos: DataFrame) -> DataFrame:
    return pos.where(~F.col("email_ok")).groupBy(reason_class(F.col("email_reason")).alias("reason")) \
        .agg(F.count(F.lit(1)).alias("n"))


def pos_summary(pos: DataFrame) -> DataFrame:
    return pos.agg(F.count(F.lit(1)).alias("total"), _cnt(F.col("email_ok")).alias("usable"),
                   _cnt(F.col("email_ok") & F.col("email_opt_in")).alias("mailable"))


def pos_top_reasons(pos: DataFrame, k: int = 8) -> DataFrame:
    g = pos.where(~F.col("email_ok")).groupBy("email_reason").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), F.asc("email_reason")).limit(k) \
        .select(reason_class(F.col("email_reason")).alias("reason_class"), "email_reason", "n")


def wifi_by_market(wifi: DataFrame) -> DataFrame:
    return wifi.where(F.col("lastmarket").isNotNull()).groupBy(F.col("lastmarket").alias("market")) \
        .agg(F.count(F.lit(1)).alias("n"))


def wifi_missing_email(wifi: DataFrame) -> DataFrame:
    return wifi.agg(_cnt(F.col("email").isNull() | (F.col("email") == "")).alias("missing_email"),
                    F.count(F.lit(1)).alias("total"))


# ---------------------------------------------------------------------------
# Master quality, consent, segments
# ---------------------------------------------------------------------------
def quality_totals(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).alias("people"),
                 _cnt(F.col("first_name").isNotNull()).alias("has_first"),
                 _cnt(F.col("last_name").isNotNull()).alias("has_last"),
                 _cnt(F.col("birthday").isNotNull()).alias("has_birthday"),
                 _cnt(F.col("nationality").isNotNull()).alias("has_nationality"),
                 _cnt(F.size("sources") > 1).alias("multi_source"))


def tag_distribution(m: DataFrame, k: int = 40) -> DataFrame:
    g = m.select(F.explode("tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), F.asc("tag")).limit(k)


def source_overlap(m: DataFrame) -> DataFrame:
    return m.groupBy(F.array_join(F.array_sort("sources"), " + ").alias("combo")) \
        .agg(F.count(F.lit(1)).alias("n"))


def duplicate_report(m: DataFrame, k: int = 15) -> DataFrame:
    d = m.where(F.col("duplicate_of").isNotNull())
    total = d.agg(F.count(F.lit(1)).alias("duplicates"))
    sample = d.orderBy("duplicate_of", "email").limit(k).select("email", "duplicate_of", "dup_reason")
    return _with_total(sample, total)


def _with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as scalar subqueries."""
    for c in total.columns:
        df = df.withColumn(c, total.select(c).scalar())
    return df


def no_brand_report(m: DataFrame, k: int = 10) -> DataFrame:
    brands = F.array(*[F.lit(b) for b in C.BRANDS])
    nb = m.where(~F.arrays_overlap(F.col("tags"), brands))
    total = nb.agg(F.count(F.lit(1)).alias("no_brand"))
    sample = nb.orderBy("email").limit(k).select("email", F.array_join("tags", ",").alias("tags"))
    return _with_total(sample, total)


def _consent_aggs():
    return [_cnt(F.col("allow_email")).alias("consented"),
            _cnt(F.col("allow_email") == F.lit(False)).alias("opted_out"),
            _cnt(F.col("allow_email").isNull()).alias("unknown")]


def consent_overall(m: DataFrame) -> DataFrame:
    return m.agg(*_consent_aggs())


def consent_by_source(m: DataFrame) -> DataFrame:
    return m.groupBy(F.array_join(F.array_sort("sources"), " + ").alias("combo")).agg(*_consent_aggs())


def consent_by_brand(m: DataFrame) -> DataFrame:
    return m.select(F.explode(_brand_tags()).alias("brand"), "allow_email").groupBy("brand").agg(*_consent_aggs())


def _brand_list(spark) -> DataFrame:
    return spark.createDataFrame([(b,) for b in C.BRANDS], "brand string")


def push_by_brand(m: DataFrame, state: DataFrame, configured=None) -> DataFrame:
    """All brands always present; pending = tagged - ok; progress rounded half
    up; ``configured``: the brand has an account (default: all have)."""
    tagged = m.select(F.explode(_brand_tags()).alias("brand")).groupBy("brand") \
        .agg(F.count(F.lit(1)).alias("tagged"))
    st = state.groupBy("brand").agg(_cnt(F.col("status") == "ok").alias("ok"),
                                    _cnt(F.col("status") == "failed").alias("failed"),
                                    _cnt(F.col("status") == "conflict").alias("conflict"))
    out = _brand_list(m.sparkSession).join(tagged, "brand", "left").join(st, "brand", "left")
    out = out.select("brand", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                                for c in ["tagged", "ok", "failed", "conflict"]])
    return out.withColumn("pending", F.col("tagged") - F.col("ok")).withColumn(
        "progress", F.when(F.col("tagged") > 0,
                           F.floor(F.col("ok") * 100.0 / F.col("tagged") + 0.5)).otherwise(F.lit(0)).cast("long")) \
        .withColumn("configured", F.col("brand").isin(list(C.BRANDS if configured is None else configured)))


def brand_coverage(m: DataFrame, state: DataFrame) -> DataFrame:
    """Tagged and pushed (ok) per brand, with the held-back duplicate and
    no-brand counts on every row."""
    pb = push_by_brand(m, state).select("brand", "tagged", F.col("ok").alias("pushed"))
    brands = F.array(*[F.lit(b) for b in C.BRANDS])
    extra = m.agg(_cnt(F.col("duplicate_of").isNotNull()).alias("duplicates_held_back"),
                  _cnt(~F.arrays_overlap(F.col("tags"), brands)).alias("no_brand"))
    return _with_total(pb, extra)


def master_summary(m: DataFrame) -> DataFrame:
    return m.agg(F.count(F.lit(1)).alias("people"), *_consent_aggs()[:1],
                 _cnt(F.col("allow_email").isNull()).alias("consent_unknown"),
                 _cnt(F.col("allow_email") == F.lit(False)).alias("opted_out"),
                 _cnt(F.col("duplicate_of").isNotNull()).alias("duplicates_held_back"),
                 _cnt(F.col("needs_push")).alias("awaiting_push"))


def minors_by_source(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("source_table").agg(F.count(F.lit(1)).alias("people"))


def segment_counts(m: DataFrame, k: int = 25) -> DataFrame:
    g = m.groupBy("brand", "country", "venue").agg(F.count(F.lit(1)).alias("people"))
    return g.orderBy(F.desc("people"), F.asc_nulls_first("brand"), F.asc_nulls_first("country"),
                     F.asc_nulls_first("venue")).limit(k)


def corrected_domains_report(wifi: DataFrame, corrections: DataFrame, k: int = 15) -> DataFrame:
    """``wrong -> right`` with record counts."""
    dom = F.lower(F.split_part(F.col("email"), F.lit("@"), F.lit(2)))
    j = wifi.select(dom.alias("wrong")).join(corrections, "wrong")
    g = j.groupBy(F.concat(F.col("wrong"), F.lit(" -> "), F.col("correct")).alias("correction")) \
        .agg(F.count(F.lit(1)).alias("records"))
    return g.orderBy(F.desc("records"), F.asc("correction")).limit(k)


def tags_json_sample(m: DataFrame, k: int = 5) -> DataFrame:
    return m.orderBy("email").limit(k).select("email", F.array_join("tags", ",").alias("tags"),
                                              json_array_text("tags").alias("como_format"))


# ---------------------------------------------------------------------------
# Signups, runs, conflicts
# ---------------------------------------------------------------------------
def signup_totals(s: DataFrame) -> DataFrame:
    st = F.col("como_status")
    return s.agg(F.count(F.lit(1)).alias("total"), _cnt(st == "ok").alias("pushed"),
                 _cnt(st == "exists").alias("already_there"), _cnt(st == "failed").alias("failed"),
                 _cnt(st.isNull()).alias("not_tried"))


def signup_by_site(s: DataFrame) -> DataFrame:
    return s.groupBy("brand", "site").agg(F.count(F.lit(1)).alias("n"))


def signup_latest(s: DataFrame, k: int = 50) -> DataFrame:
    return s.orderBy(F.desc("signed_up_at"), F.asc("email")).limit(k) \
        .select("email", "brand", "site", "como_status", "como_detail", "signed_up_at")


def latest_runs(runs: DataFrame, k: int = 50) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.asc("id")).limit(k).select("id", "job", "started_at", "finished_at", "status")


def conflict_queue(state: DataFrame, m: DataFrame, k: int = 200) -> DataFrame:
    s = state.where(F.col("status").isin("conflict", "failed"))
    j = s.join(m.select("email", "first_name", "last_name", "tags"), "email", "left")
    return j.orderBy("status", F.desc("last_pushed_at"), "email", "brand").limit(k) \
        .select("email", "brand", "status", "detail", "last_pushed_at", "first_name", "last_name",
                F.array_join("tags", ",").alias("tags"))


# ---------------------------------------------------------------------------
# Pre-flight checks on the push queue
# ---------------------------------------------------------------------------
def _queued(m: DataFrame) -> DataFrame:
    return m.where(F.coalesce(F.col("needs_push"), F.lit(False)))


def _collisions(m: DataFrame) -> DataFrame:
    q = _queued(m).where(F.col("duplicate_of").isNull() & F.col("email_key").isNotNull())
    return q.groupBy("email_key").agg(F.count(F.lit(1)).alias("records"), F.min("email").alias("first_email")).where("records > 1")


def preflight_inbox_collisions(m: DataFrame, k: int = C.PREFLIGHT_SAMPLE) -> DataFrame:
    """Inbox keys shared by more than one queued non-duplicate record
    (size and first address per key; members are rows, never an array)."""
    return _collisions(m).orderBy("email_key").limit(k)


def preflight_collision_members(m: DataFrame) -> DataFrame:
    """The queued records of every shared inbox, as rows."""
    q = _queued(m).where(F.col("duplicate_of").isNull()).select("email_key", "email")
    return q.join(_collisions(m).select("email_key", "records"), "email_key").select("email_key", "records", "email")


def _settled(m: DataFrame, state: DataFrame) -> DataFrame:
    s = state.where(F.col("status").isin("ok", "exists")).select("email", "brand", "status")
    return _queued(m).select("email").join(s, "email")


def preflight_already_settled(m: DataFrame, state: DataFrame, k: int = C.PREFLIGHT_SAMPLE) -> DataFrame:
    return _settled(m, state).orderBy("email", "brand").limit(k)


def preflight_leaked_duplicates(m: DataFrame, k: int = C.PREFLIGHT_SAMPLE) -> DataFrame:
    return _queued(m).where(F.col("duplicate_of").isNotNull()).orderBy("email").limit(k) \
        .select("email", "duplicate_of")


def preflight_unrouted(m: DataFrame, k: int = C.PREFLIGHT_SAMPLE) -> DataFrame:
    brands = F.array(*[F.lit(b) for b in C.BRANDS])
    return _queued(m).where(~F.arrays_overlap(F.col("tags"), brands)).orderBy("email").limit(k) \
        .select("email", F.array_join("tags", ",").alias("tags"))


def preflight_summary(m: DataFrame, state: DataFrame) -> DataFrame:
    """check, pass, count (capped at the sample size), total (uncapped),
    queued, all_clear.  One conditional aggregate over the master and one pass
    for each of the two keyed checks."""
    q = F.coalesce(F.col("needs_push"), F.lit(False))
    brands = F.array(*[F.lit(b) for b in C.BRANDS])
    one = m.agg(_cnt(q & F.col("duplicate_of").isNotNull()).alias("n3"), _cnt(q & ~F.arrays_overlap(F.col("tags"), brands)).alias("n4"),
                _cnt(q & F.col("duplicate_of").isNull()).alias("queued"))
    one = _with_total(one, _collisions(m).agg(F.count(F.lit(1)).alias("n1")))
    one = _with_total(one, _settled(m, state).agg(F.count(F.lit(1)).alias("n2")))
    checks = F.array(*[F.struct(F.lit(i).alias("check_no"), F.lit(name).alias("check"), F.col(f"n{i}").cast("long").alias("total"))
                       for i, name in enumerate(C.PREFLIGHT_CHECKS, 1)])
    clear = (F.col("n1") == 0) & (F.col("n2") == 0) & (F.col("n3") == 0) & (F.col("n4") == 0)
    return one.select(F.inline(checks), "queued", clear.alias("all_clear")).select(
        "check_no", "check", F.least("total", F.lit(C.PREFLIGHT_SAMPLE)).cast("long").alias("count"), "total",
        (F.col("total") == 0).alias("pass"), "queued", "all_clear")


def top_possible_duplicates(groups: DataFrame, k: int = 20) -> DataFrame:
    """The largest groups of people with equal names and birthday."""
    return groups.orderBy(F.desc("records"), F.asc("first_name"), F.asc("last_name"), F.asc_nulls_first("birthday")).limit(k)


# ---------------------------------------------------------------------------
# Pipeline overview
# ---------------------------------------------------------------------------
def pipeline_overview(wifi: DataFrame | None, pos: DataFrame | None, sync_state: DataFrame | None,
                      m: DataFrame | None, state: DataFrame | None) -> DataFrame:
    """One row per stage; an absent table gives a row with NULL counts."""
    spark = next(x for x in (wifi, pos, m, state) if x is not None).sparkSession
    cols = "stage string, rows long, usable long, pending long, ok long, failed long, conflict long, " \
           "last_load timestamp_ntz, detail string, warn boolean"
    out = []
    if wifi is not None:
        out.append(wifi.agg(F.count(F.lit(1)).alias("rows"), F.max("updated_at").cast("timestamp_ntz")
                            .alias("last_load")).select(F.lit("wifi").alias("stage"), "rows", "last_load",
                                                        F.lit("document store").alias("detail")))
    else:
        out.append(spark.createDataFrame([("wifi", "not set up")], "stage string, detail string"))
    if pos is not None:
        p = pos.agg(F.count(F.lit(1)).alias("rows"), _cnt(F.col("email_ok")).alias("usable"),
                    F.max("updated_at").cast("timestamp_ntz").alias("last_load"))
        if sync_state is not None:
            inc = sync_state.agg(F.array_join(F.array_sort(F.collect_set(
                F.when(~F.col("backfill_complete"), F.col("brand")))), ", ").alias("inc"))
        else:
            inc = spark.createDataFrame([("",)], "inc string")
        p = _with_total(p, inc).select(
            F.lit("revel").alias("stage"), "rows", "usable", "last_load",
            F.when(F.col("inc") != "", F.concat(F.lit("backfilling: "), F.col("inc")))
            .otherwise(F.lit("up to date")).alias("detail"), (F.col("inc") != "").alias("warn"))
        out.append(p)
    else:
        out.append(spark.createDataFrame([("revel", "not set up")], "stage string, detail string"))
    if m is not None:
        mm = m.agg(F.count(F.lit(1)).alias("rows"), _cnt(F.col("needs_push")).alias("pending"))
        out.append(mm.select(F.lit("master").alias("stage"), "rows", "pending",
                             F.concat(F.col("pending").cast("string"), F.lit(" awaiting push")).alias("detail"),
                             (F.col("pending") > 0).alias("warn")))
    else:
        out.append(spark.createDataFrame([("master", "not built")], "stage string, detail string"))
    if state is not None:
        s = state.agg(_cnt(F.col("status") == "ok").alias("ok"), _cnt(F.col("status") == "failed").alias("failed"),
                      _cnt(F.col("status") == "conflict").alias("conflict"),
                      F.max("last_pushed_at").cast("timestamp_ntz").alias("last_load"))
        out.append(s.select(F.lit("como").alias("stage"), F.col("ok").alias("rows"), "ok", "failed", "conflict",
                            "last_load", F.concat(F.col("failed").cast("string"), F.lit(" failed, "),
                                                  F.col("conflict").cast("string"), F.lit(" conflicts")).alias("detail"),
                            ((F.col("failed") + F.col("conflict")) > 0).alias("warn")))
    else:
        out.append(spark.createDataFrame([("como", "nothing pushed yet")], "stage string, detail string"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o, allowMissingColumns=True)
    schema_cols = [c.split(" ")[0] for c in cols.split(", ")]
    return res.select(*[F.col(c) if c in res.columns else F.lit(None).alias(c) for c in schema_cols])


def report_bundle(m: DataFrame) -> DataFrame:
    """Quality, consent, tag, segment and overlap counts from one scan.

    Every master row gives its keys ``(report, key)`` (itself, its source
    combination, its tags, brands and segments), one aggregation counts all
    measures per key, and it combines map-side, so what is shuffled is the number
    of keys, not of rows.  ``report, key, people, consented, opted_out, unknown,
    has_first, has_last, has_birthday, has_nationality, multi_source``.
    """
    def key(report: str, value) -> Column:
        return F.struct(F.lit(report).alias("report"), value.alias("key"))

    combo = F.array_join(F.array_sort("sources"), " + ")
    tags = F.coalesce(F.array_distinct("tags"), F.array().cast("array<string>"))
    brands = F.array(*[F.lit(b) for b in C.BRANDS])
    single = [key("total", F.lit("")), key("sources", combo), *[key(f"segment {c}", F.col(c)) for c in ("src_system", "brand", "country", "venue")]]
    keys = F.concat(F.array(*single), F.transform(tags, lambda t: key("tag", t)), F.transform(F.array_intersect(tags, brands), lambda t: key("brand", t)))
    has = {"first": "first_name", "last": "last_name", "birthday": "birthday", "nationality": "nationality"}
    flags = m.select(F.explode(F.filter(keys, lambda k: k["key"].isNotNull())).alias("k"), "allow_email",
                     *[F.col(c).isNotNull().alias(f"_{n}") for n, c in has.items()], (F.size("sources") > 1).alias("_multi"))
    return flags.groupBy("k.report", "k.key").agg(
        F.count(F.lit(1)).alias("people"), *_consent_aggs(), *[_cnt(F.col(f"_{n}")).alias(f"has_{n}") for n in has], _cnt(F.col("_multi")).alias("multi_source"))
