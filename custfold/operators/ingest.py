"""Sources, ingest and upsert (batch).

Upserts are set-based: the old table and the new rows are unioned and one
row per key is chosen with ``max``/``min`` of ``struct(order, row)`` (and
the signup fold with min/max of value-with-sequence structs).  Those
aggregates combine map-side, so a key holding a third of all rows is
reduced inside each map task before the shuffle instead of landing whole
in one reducer (a window over the key would).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custfold import config as C
from custfold.functions.common import ts_ntz
from custfold.functions.email import has_reason, py_strip, reason_class, with_email_check
from custfold.functions.text import blank_to_null


# ---------------------------------------------------------------------------
# Generic keyed selection
# ---------------------------------------------------------------------------
def pick_by_key(df: DataFrame, keys: list[str], order: Column, latest: bool = True) -> DataFrame:
    """One row per key: the row with the greatest (or least) ``order``.

    ``order`` must be non-null and unique within a key (e.g. a struct of
    batch number and arrival sequence).
    """
    cols = [c for c in df.columns]
    # max/min of struct(order, row): struct comparison is by the first
    # field, so this picks the row with the extreme order; it combines
    # map-side like any max.
    packed = F.struct(order.alias("_o"), F.struct(*[F.col(c) for c in cols]).alias("_r"))
    pick = F.max if latest else F.min
    return df.groupBy(*keys).agg(pick(packed).alias("_p")).select("_p._r.*")


def _truthy(c: Column, dtype: T.DataType) -> Column:
    """Python ``bool(x)`` for a column of the given type (NULL -> False)."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.coalesce(c != "", F.lit(False))
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c != 0, F.lit(False))
    return c.isNotNull()


# ---------------------------------------------------------------------------
# Point-of-sale feed
# ---------------------------------------------------------------------------
def ingest_pos_customers(raw: DataFrame, brand_col: str = "_brand") -> DataFrame:
    """Raw feed rows -> typed rows with the email classified (see ``pos_rows``
    for the typed columns)."""
    return classified_pos_rows(pos_rows(raw, brand_col))


def pos_rows(raw: DataFrame, brand_col: str = "_brand") -> DataFrame:
    """Raw feed rows -> typed rows, the email as it came.

    ``revel_id`` is the stripped ``resource_uri`` (falling back to ``id``
    when the uri is empty); rows with neither are dropped.  Unparsable
    ``updated_date`` becomes NULL; ``email_opt_in`` is Python truthiness.
    """
    cols = set(raw.columns)
    uri = F.nullif(F.col("resource_uri").cast("string"), F.lit("")) if "resource_uri" in cols else F.lit(None)
    rid = F.nullif(F.col("id").cast("string"), F.lit("")) if "id" in cols else F.lit(None)
    revel_id = py_strip(F.coalesce(uri, rid).cast("string"))
    opt_in_type = raw.schema["email_opt_in"].dataType if "email_opt_in" in cols else T.NullType()
    opt_in = _truthy(F.col("email_opt_in"), opt_in_type) if "email_opt_in" in cols else F.lit(False)
    stamp = F.col("updated_date").cast("string") if "updated_date" in cols else F.lit(None).cast("string")
    if "_seq" not in cols:
        raise ValueError("the feed needs its arrival order in a column _seq")
    return (raw
            .select(revel_id.alias("revel_id"),
                    F.col(brand_col).alias("brand"),
                    F.col("first_name"), F.col("last_name"), F.col("email"),
                    opt_in.alias("email_opt_in"),
                    stamp.alias("_stamp"),
                    F.col("_seq"))
            .where(F.col("revel_id") != ""))


def classified_pos_rows(typed: DataFrame) -> DataFrame:
    return (with_email_check(typed, "email")
            .select("revel_id", "brand", "first_name", "last_name", "email", "email_ok",
                    "email_opt_in",
                    F.expr("try_cast(_stamp AS TIMESTAMP_NTZ)").alias("updated_date"),
                    "email_reason", "email_reason_pre", "_seq"))


def discard_rejects(classified: DataFrame, reasons=None) -> tuple[DataFrame, DataFrame]:
    """Split off rows whose reason class is to be thrown away before storing."""
    reasons = list(C.DISCARD_REASONS if reasons is None else reasons)
    by_address = has_reason("email", reasons)
    if by_address is not None:
        # The cleaned address tells: the checks are not repeated in the filter.
        hit = by_address
    elif "email_reason_pre" in classified.columns:
        # Test the small pre-gibberish reason; the score only when the
        # gibberish class itself is discarded.
        pre = F.col("email_reason_pre")
        hit = F.coalesce(pre.isin(reasons), F.lit(False))
        if "gibberish" in reasons:
            hit = hit | (pre.isNull() & ~F.col("email_ok"))
    else:
        hit = F.coalesce(reason_class(F.col("email_reason")).isin(reasons), F.lit(False))
    return classified.where(~hit), classified.where(hit)


POS_COLUMNS = ["revel_id", "brand", "first_name", "last_name", "email", "email_ok",
               "email_opt_in", "updated_date", "email_reason", "updated_at"]


def upsert_pos_customers(existing: DataFrame | None, rows: DataFrame,
                         run_ts: _dt.datetime = C.RUN_TS, key_cols=("revel_id",), unique: bool = False) -> DataFrame:
    """Insert or replace by key; the last arrival wins; ``updated_at`` = run_ts.
    ``unique`` says that no key is repeated in ``rows``."""
    new = (rows if unique else newest_arrivals(rows, list(key_cols))).select(*[c for c in POS_COLUMNS if c != "updated_at"]) \
        .withColumn("updated_at", ts_ntz(run_ts))
    if existing is None:
        return new
    old = existing.select(*POS_COLUMNS)
    same = F.lit(True)
    for k in key_cols:
        same = same & old[k].eqNullSafe(new[k])
    return old.join(new, same, "left_anti").unionByName(new)


def newest_arrivals(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the greatest ``_seq`` per key (``_seq`` is unique).

    Only key and number go through the aggregation, which is hash-based and
    combines map-side; the rows are then shuffled once by key and number, so a
    hot key is spread over all tasks.
    """
    last = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_seq").alias("_last"))
    same = rows["_seq"] == last["_last"]
    for i, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(last[f"_k{i}"])
    return rows.join(last, same, "left_semi")


def revel_customers(raw: DataFrame, existing: DataFrame | None = None,
                    run_ts: _dt.datetime = C.RUN_TS, reasons=None) -> DataFrame:
    """Feed -> discard -> newest per key -> classify: the stored POS customer table.

    Where the discarded reasons can be told from the address alone, the rows
    are dropped and the newest arrival is picked first, so that the checks run
    once for each row that is stored."""
    reasons = list(C.DISCARD_REASONS if reasons is None else reasons)
    hit = has_reason("email", reasons)
    if hit is None:
        kept, _ = discard_rejects(ingest_pos_customers(raw), reasons)
        return upsert_pos_customers(existing, kept, run_ts)
    newest = newest_arrivals(pos_rows(raw).where(~hit), ["revel_id"])
    return upsert_pos_customers(existing, classified_pos_rows(newest), run_ts, unique=True)


def pos_write_stats(raw: DataFrame) -> DataFrame:
    """Counts of one write batch: ok / rejected / discarded and per reason class."""
    typed = ingest_pos_customers(raw)
    cls = reason_class(F.col("email_reason"))
    discarded = F.coalesce(cls.isin(list(C.DISCARD_REASONS)), F.lit(False))
    outcome = (F.when(discarded, F.lit("discarded"))
               .when(F.col("email_ok"), F.lit("ok")).otherwise(F.lit("rejected")))
    # One pass over the classified rows; the few groups are then reshaped.
    groups = typed.groupBy(outcome.alias("outcome"), cls.alias("class")).agg(F.count(F.lit(1)).alias("n"))
    shaped = groups.select("n", F.explode(F.array(
        F.struct(F.lit("outcome").alias("kind"), F.col("outcome").alias("reason")),
        F.struct(F.lit("reason").alias("kind"), F.when(F.col("outcome") != "discarded", F.col("class")).alias("reason")))).alias("s"))
    return shaped.where(F.col("s.reason").isNotNull()).groupBy("s.kind", "s.reason").agg(F.sum("n").cast("long").alias("n"))


# ---------------------------------------------------------------------------
# Incremental load state for the POS feed
# ---------------------------------------------------------------------------
SYNC_STATE_SCHEMA = T.StructType([
    T.StructField("brand", T.StringType()),
    T.StructField("backfill_offset", T.LongType()),
    T.StructField("backfill_complete", T.BooleanType()),
    T.StructField("watermark", T.TimestampNTZType()),
    T.StructField("last_run_at", T.TimestampNTZType()),
])


def incremental_slice(feed: DataFrame, state: DataFrame, brand_col: str = "_brand") -> DataFrame:
    """Rows a run would fetch: email contains ``@``; brands whose backfill
    is complete and that hold a watermark only get rows updated on or after
    ``watermark - 1 day``; other brands get everything.

    The join with the state (one row per brand) is left to the planner.  A
    feed landed by ``land_feed`` is partitioned by day, and the filter on
    ``updated_day`` then prunes folders (``since_day`` gives the bound).
    """
    st = state.select(F.col("brand").alias("_st_brand"), "backfill_complete", "watermark")
    stamp = F.expr("try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ)")
    joined = feed.join(st, F.col(brand_col) == F.col("_st_brand"), "left")
    incremental = F.coalesce(F.col("backfill_complete"), F.lit(False)) & F.col("watermark").isNotNull()
    since = F.col("watermark") - F.expr("INTERVAL 1 DAY")
    keep = F.col("email").contains("@") & (~incremental | F.coalesce(stamp >= since, F.lit(False)))
    return joined.where(keep).drop("_st_brand", "backfill_complete", "watermark")


def land_feed(feed: DataFrame, path: str, brand_col: str = "_brand") -> None:
    """Write the feed partitioned by brand and day of ``updated_date`` (rows
    without a parsable date in a folder of their own)."""
    day = F.expr("coalesce(CAST(CAST(try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ) AS DATE) AS STRING), 'none')")
    feed.withColumn("updated_day", day).withColumn("feed_brand", F.col(brand_col)) \
        .write.partitionBy("feed_brand", "updated_day").parquet(path)


def landed_slice(landed: DataFrame, marks: dict, brand_col: str = "_brand") -> DataFrame:
    """The incremental slice of a landed feed.  ``marks`` holds per brand the
    watermark, or None while its backfill runs (bounded by the number of brand
    accounts); the day bounds become partition filters of the scan."""
    day, stamp = F.col("updated_day"), F.expr("try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ)")
    known = {b: m - _dt.timedelta(days=1) for b, m in marks.items() if m is not None}
    keep = ~F.col("feed_brand").isin(list(known)) if known else F.lit(True)
    for brand, since in known.items():
        fresh = (day >= since.date().isoformat()) & (day != "none") & (stamp >= ts_ntz(since))
        keep = keep | ((F.col("feed_brand") == brand) & fresh)
    return landed.where(keep & F.col("email").contains("@")).drop("feed_brand", "updated_day")


def advance_watermark(state: DataFrame | None, rows: DataFrame, run_ts: _dt.datetime = C.RUN_TS,
                      brand_col: str = "_brand", brands=None, end_of_feed: bool = True) -> DataFrame:
    """Per brand of the run: new mark = max(prior, newest parsable
    updated_date) (old mark kept when nothing parsed); offset 0 and complete
    at end of feed.  ``brands`` names the brands of the run (default: those of
    ``rows``); the state of all others stays as it is, as does offset and
    completion of a run that stopped early (``end_of_feed=False``)."""
    stamp = F.expr("try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ)")
    newest = rows.groupBy(F.col(brand_col).alias("brand")).agg(F.max(stamp).alias("_newest"))
    if brands is not None:
        seen = rows.sparkSession.createDataFrame([(b,) for b in brands], "brand string")
        newest = seen.join(newest, "brand", "left")
    newest = newest.withColumn("_run", F.lit(True))
    if state is None:
        state = rows.sparkSession.createDataFrame([], SYNC_STATE_SCHEMA)
    merged = state.join(newest, "brand", "full")
    run = F.col("_run").isNotNull()
    done = run & F.lit(end_of_feed)
    return merged.select(
        "brand",
        F.when(done, F.lit(0)).otherwise(F.coalesce("backfill_offset", F.lit(0))).cast("long").alias("backfill_offset"),
        (done | F.coalesce("backfill_complete", F.lit(False))).alias("backfill_complete"),
        F.greatest(F.col("watermark"), F.col("_newest")).alias("watermark"),
        F.when(run, ts_ntz(run_ts)).otherwise(F.col("last_run_at")).alias("last_run_at"))


# ---------------------------------------------------------------------------
# Newsletter signups
# ---------------------------------------------------------------------------
def accept_signups(events: DataFrame, seq_col: str = "event_id", ts_col: str = "ts") -> DataFrame:
    """Validate form posts; every row kept with ``reject_reason`` (NULL = ok)."""
    email = F.lower(py_strip(F.coalesce(F.col("email"), F.lit(""))))
    site = F.lower(py_strip(F.coalesce(F.col("site"), F.lit(""))))
    site_map = F.create_map(*[x for k, v in C.SITE_BRANDS.items() for x in (F.lit(k), F.lit(v))])
    given = F.nullif(F.col("brand"), F.lit(""))
    brand = F.upper(py_strip(F.coalesce(given, F.try_element_at(site_map, site), F.lit(""))))
    country = F.upper(py_strip(F.coalesce(F.nullif(F.col("country"), F.lit("")),
                                          F.lit(C.DEFAULT_SIGNUP_COUNTRY))))
    reason = (F.when((email == "") | ~email.contains("@"), F.lit("a valid email is required"))
              .when(~brand.isin(C.BRANDS),
                    F.concat(F.lit("unknown site or brand: "),
                             F.when(site != "", site).otherwise(brand))))
    return events.select(
        F.col(seq_col).alias("seq"), F.col(ts_col).alias("ts"),
        email.alias("email"), brand.alias("brand"), country.alias("country"),
        site.alias("site"), blank_to_null(F.col("page")).alias("page"),
        blank_to_null(F.col("first_name")).alias("first_name"),
        blank_to_null(F.col("last_name")).alias("last_name"),
        reason.alias("reject_reason"))


SIGNUP_COLUMNS = ["email", "brand", "country", "src_system", "site", "page", "first_name",
                  "last_name", "como_status", "como_detail", "como_at", "signed_up_at", "updated_at"]


def signup_state(accepted: DataFrame, batch: int = 1) -> DataFrame:
    """Per-email mergeable state of accepted signups.

    Each field is kept together with the ordering it was seen at, so
    states from different micro-batches merge with min/max in any order
    and a replayed batch changes nothing.
    """
    ok = accepted.where(F.col("reject_reason").isNull())
    return ok.groupBy("email").agg(*signup_folds(batch))


def signup_folds(batch: int = 1, present: Column | None = None) -> list[Column]:
    """The aggregates of ``signup_state``; with ``present`` only rows for which it
    holds can be an email's first row."""
    o = F.struct(F.lit(batch).alias("b"), F.col("seq").alias("s"))

    def oldest(c):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(o.alias("o"), F.col(c).alias("v")))).alias(c)

    def newest(c):
        return F.max(F.when(F.col(c).isNotNull(), F.struct(o.alias("o"), F.col(c).alias("v")))).alias(c)

    row = F.struct(o.alias("o"), F.col("site").alias("site"), F.col("page").alias("page"), F.col("ts").alias("ts"))
    first_row = F.min(row if present is None else F.when(present, row)).alias("first_row")
    return [oldest("brand"), oldest("country"), newest("first_name"), newest("last_name"), first_row]


def merge_signup_states(a: DataFrame, b: DataFrame) -> DataFrame:
    """Fold two states (union + min/max), associative and idempotent."""
    u = a.unionByName(b)
    return u.groupBy("email").agg(
        F.min("brand").alias("brand"), F.min("country").alias("country"),
        F.max("first_name").alias("first_name"), F.max("last_name").alias("last_name"),
        F.min("first_row").alias("first_row"))


def signups_from_state(state: DataFrame, run_ts: _dt.datetime = C.RUN_TS, keep: tuple = ()) -> DataFrame:
    """Surface the stored table columns from a signup state (and the state's
    columns ``keep``)."""
    return state.select(
        "email", F.col("brand.v").alias("brand"), F.col("country.v").alias("country"),
        F.lit("NEWSLETTER").alias("src_system"),
        F.col("first_row.site").alias("site"), F.col("first_row.page").alias("page"),
        F.col("first_name.v").alias("first_name"), F.col("last_name.v").alias("last_name"),
        F.lit(None).cast("string").alias("como_status"), F.lit(None).cast("string").alias("como_detail"),
        F.lit(None).cast("timestamp_ntz").alias("como_at"),
        F.col("first_row.ts").cast("timestamp_ntz").alias("signed_up_at"),
        ts_ntz(run_ts).alias("updated_at"), *keep)


def upsert_signups(rows: DataFrame, run_ts: _dt.datetime = C.RUN_TS, existing: DataFrame | None = None) -> DataFrame:
    """Batch upsert of accepted signups into the newsletter table.

    With ``existing``, a stored email keeps its first values (brand, country,
    site, page, signup time) and its recorded push outcome, takes newer
    non-empty names, and gets ``updated_at`` = run_ts; emails without a new
    row stay untouched.
    """
    new = signups_from_state(signup_state(rows), run_ts)
    if existing is None:
        return new
    o, n = existing.alias("o"), new.alias("n")
    j = o.join(n, F.col("o.email") == F.col("n.email"), "full")
    old, fresh = F.col("o.email").isNotNull(), F.col("n.email").isNotNull()

    def value(c):
        if c in ("email", "brand", "country"):
            return F.coalesce(f"o.{c}", f"n.{c}")
        if c in ("first_name", "last_name"):
            return F.coalesce(f"n.{c}", f"o.{c}")
        if c == "updated_at":
            return F.when(fresh, F.col("n.updated_at")).otherwise(F.col("o.updated_at"))
        return F.when(old, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}"))

    return j.select(*[value(c).alias(c) for c in SIGNUP_COLUMNS])


def newsletter_signups(events: DataFrame, run_ts: _dt.datetime = C.RUN_TS) -> DataFrame:
    return upsert_signups(accept_signups(events), run_ts)


# ---------------------------------------------------------------------------
# Document ingest with schema evolution and partial upsert
# ---------------------------------------------------------------------------
def _json_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c


def _lowered(batch: DataFrame) -> dict[str, Column]:
    """Lower-case field name -> value; names that differ in case only are one
    field (the first value that is not NULL)."""
    groups: dict[str, list[Column]] = {}
    for i, f in enumerate(batch.schema.fields):
        groups.setdefault(f.name.lower(), []).append(_json_text(F.col(f"c{i}"), f.dataType))
    return {k: v[0] if len(v) == 1 else F.coalesce(*v) for k, v in groups.items()}


def _numbered(batch: DataFrame) -> DataFrame:
    """The columns by position (names may differ in case only)."""
    return batch.toDF(*[f"c{i}" for i in range(len(batch.columns))])


def fields_with_values(batch: DataFrame) -> list[str]:
    """Lower-case names of the fields that hold a value in some row (one
    aggregation over the batch, run here)."""
    cols = _lowered(batch)
    row = _numbered(batch).select(*[v.alias(f"c{i}") for i, v in enumerate(cols.values())]) \
        .agg(*[F.count(f"c{i}").alias(f"c{i}") for i in range(len(cols))]).first()
    return [c for i, c in enumerate(cols) if row[i]]


def ingest_docs_evolving(existing: DataFrame | None, batch: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Lower-case field names, nested values as JSON text, and widen the
    table by name: a field unseen so far becomes a new column, rows that
    lack a column hold NULL there.  With ``fields`` (see
    ``fields_with_values``) a field unseen so far waits for a value."""
    held = [] if existing is None else existing.columns
    lowered = _numbered(batch).select(*[v.alias(c) for c, v in _lowered(batch).items() if fields is None or c in fields or c in held])
    if existing is None:
        return lowered
    return existing.unionByName(lowered, allowMissingColumns=True)


def docs_from_json(raw: DataFrame, fields: list[str], json_col: str = "body") -> DataFrame:
    """Documents as JSON text -> one text column per field (nested values as
    JSON text) and ``_present``, the field names each document has."""
    j = F.col(json_col)
    keys = F.coalesce(F.json_object_keys(j), F.array().cast("array<string>"))
    value = F.from_json(j, "map<string,string>")
    kept = [c for c in raw.columns if c != json_col]
    lowered = F.transform_keys(value, lambda k, _v: F.lower(k))
    return raw.select(*kept, *[F.try_element_at(lowered, F.lit(f)).alias(f) for f in fields], keys.alias("_present"))


def upsert_docs_partial(existing: DataFrame | None, batch: DataFrame, key: str = "doc_id",
                        run_ts: _dt.datetime = C.RUN_TS, order_col: str | None = None,
                        present_col: str = "_present") -> DataFrame:
    """Insert or update by key; only the fields a document has overwrite (an
    explicit NULL overwrites too); the others keep their values.

    A batch with ``present_col`` names the fields of each document; without
    it every document has the batch's columns.  Several versions of a key in
    one batch are folded first, in the order of ``order_col``: each field
    comes from the last version that has it (one map-side-combined aggregate
    per key), so the key stays unique.  A batch without ``order_col`` must
    hold one document per key.
    """
    at = {c: F.col(f"c{i}") for i, c in enumerate(batch.columns)}
    cols = {c: v for c, v in _lowered(batch).items() if c not in (key, present_col, order_col)}
    order = at[order_col] if order_col else F.lit(0)
    if present_col in at:
        present = F.transform(at[present_col], lambda x: F.lower(x))
        has = {c: F.array_contains(present, c) for c in cols}
    else:
        has = {c: F.lit(True) for c in cols}
    # Columns by number: a document may name its fields in any way.
    held = [] if existing is None else [c for c in existing.columns if c not in (key, "updated_at")]
    names = held + [c for c in cols if c not in held]
    at_new = {c: F.col(f"_n{i}") for i, c in enumerate(cols)}
    new = _numbered(batch).groupBy(at[key].alias("_kn")).agg(
        F.lit(True).alias("_in_batch"),
        *[F.max_by(F.struct(v.alias("v")), F.when(has[c], order)).alias(f"_n{i}") for i, (c, v) in enumerate(cols.items())])
    if existing is None:
        return new.select(F.col("_kn").alias(key), *[at_new[c]["v"].alias(c) for c in names], ts_ntz(run_ts).alias("updated_at"))
    at_old = {c: F.col(f"_o{i}") for i, c in enumerate(held)}
    o = existing.select(F.col(key).alias("_k"), *[F.col("`" + c.replace("`", "``") + "`").alias(f"_o{i}") for i, c in enumerate(held)],
                        F.col("updated_at").alias("_o_updated_at"))
    j = o.join(new, F.col("_k") == F.col("_kn"), "full")
    out = [F.coalesce("_k", "_kn").alias(key)]
    for c in names:
        if c not in cols:
            out.append(at_old[c].alias(c))
        elif c not in held:
            out.append(at_new[c]["v"].alias(c))
        else:
            out.append(F.when(at_new[c].isNotNull(), at_new[c]["v"]).otherwise(at_old[c]).alias(c))
    out.append(F.when(F.col("_in_batch"), ts_ntz(run_ts)).otherwise(F.col("_o_updated_at")).alias("updated_at"))
    return j.select(*out)


# ---------------------------------------------------------------------------
# Probes
# ---------------------------------------------------------------------------
def filter_selectivity(df: DataFrame, predicates: dict[str, str]) -> DataFrame:
    """Rows matching each predicate and their share of all rows, one pass."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, (label, pred) in enumerate(predicates.items()):
        aggs.append(F.count_if(F.coalesce(F.expr(pred), F.lit(False))).alias(f"_p{i}"))
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(label).alias("label"), F.col(f"_p{i}").alias("n")) for i, label in enumerate(predicates)])
    return one.select("_total", F.inline(pairs)) \
        .select("label", F.col("n").cast("long").alias("n"),
                F.round(F.col("n") * 100.0 / F.nullif(F.col("_total"), F.lit(0)), 1).alias("pct"))


def field_profile(df: DataFrame, width: int = 70) -> DataFrame:
    """Row count, and every field name (sorted) with a sample value cut to
    ``width`` chars (the smallest non-null value, so it is deterministic)."""
    names = sorted(df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")] + \
        [F.min(F.col(f"`{c}`").cast("string")).alias(f"_f{i}") for i, c in enumerate(names)]
    one = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_f{i}").alias("sample")) for i, c in enumerate(names)])
    return one.select(F.col("_rows").alias("rows"), F.inline(pairs)) \
        .select("rows", "field", F.substring("sample", 1, width).alias("sample"))
