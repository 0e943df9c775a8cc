"""Master build: one row per person from many sources (entity resolution).

Plan shape at scale
-------------------
* Every source is projected through its registry row into canonical rows
  (pure column expressions, filters push into the scan).
* All canonical rows (and the prior master, if any) are unioned and
  aggregated **once** by email.  For each source rank the aggregate keeps
  the row with the smallest source key (``min_by`` with a FILTER), which
  is the within-source "one row per email".  ``min_by`` combines map-side,
  so even an email holding a third of all rows leaves each map task as one
  row per source.
* The merge itself (first non-null per field in priority order, ordered
  tag union, source set, change detection, per-source merge counts) is
  then a projection over a bounded number of per-source structs: no
  further shuffle, no window, no collected lists.
* Duplicate inboxes: keeper per ``email_key`` by aggregation, joined back
  many-to-one (AQE splits a skewed key).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custfold import config as C
from custfold.config import Dimensions, SourceSpec, ordered_specs
from custfold.session import ensure_checkpoint_dir
from custfold.functions.common import let, ts_ntz
from custfold.functions.email import fix_domain, inbox_key, is_blocked_domain, is_valid_address
from custfold.functions.sql import register_rules
from custfold.functions.text import (clean_birthday, clean_name, clean_nationality, clean_tags,
                                     first_tag_in, first_tag_not_in, is_adult)



def _empty() -> Column:
    return F.array().cast("array<string>")


FIELDS = ["first_name", "last_name", "nationality", "birthday", "allow_email"]
MASTER_COLUMNS = ["email", "first_name", "last_name", "nationality", "birthday", "tags",
                  "src_system", "brand", "country", "venue", "allow_email", "email_key",
                  "duplicate_of", "dup_reason", "sources", "needs_push", "last_pushed_at",
                  "push_status"]


def _eval(x, dtype: str) -> Column:
    """A registry cell: an SQL expression (the rules of ``functions/sql.py`` are
    functions in it)."""
    return F.lit(None).cast(dtype) if x is None else F.expr(x)


# ---------------------------------------------------------------------------
# Registry projection
# ---------------------------------------------------------------------------
def registry_project(df: DataFrame, spec: SourceSpec, as_of: _dt.date = C.AS_OF,
                     dims: Dimensions | None = None) -> DataFrame:
    """Source rows -> canonical rows after every filter, before dedupe.

    Filter order: correct domain -> format -> digits-only -> blocked ->
    ``where_extra`` -> age gate (on the raw birthday); the stored birthday
    is the cleaned one.  ``dims`` replaces the dimension tables.
    """
    dims = dims or Dimensions()
    register_rules(df.sparkSession, dims, as_of)
    # Bind the corrected email and the raw birthday once (each is used
    # several times below) before filtering.
    where_extra = F.expr(spec.where_extra) if spec.where_extra else F.lit(True)

    def gate(v):
        e, b = v["e1"], v["bday"]
        return is_valid_address(e) & ~is_blocked_domain(e, dims.blocked) & v["extra"] & is_adult(b, as_of)

    plain = isinstance(spec.email_expr, str) and spec.email_expr.isidentifier()
    if plain:
        # A bare column is cheap to repeat: plain expressions stay in codegen.
        df = df.withColumn("_e1", fix_domain(F.col(spec.email_expr), dims.corrections))
    else:
        # A computed email is bound once so pushed-down filters stay small.
        bound = let(F.struct(_eval(spec.email_expr, "string").alias("raw")),
                    lambda r: F.struct(fix_domain(r["raw"], dims.corrections).alias("e1")))
        df = df.withColumn("_e1", bound["e1"])
    df = df.withColumn("_bday", _eval(spec.birthday_expr, "date"))
    e1 = F.col("_e1")
    bday = F.col("_bday")
    keep = (gate(F.struct(e1.alias("e1"), bday.alias("bday"), where_extra.alias("extra"))) if plain
            else let(F.struct(e1.alias("e1"), bday.alias("bday"), where_extra.alias("extra")), gate))
    tags = clean_tags(F.concat(F.array(F.lit(spec.source_tag)),
                               F.coalesce(_eval(spec.extra_tags_expr, "array<string>"), _empty())))
    first = clean_name(_eval(spec.first_name_expr, "string")) if spec.first_name_expr else F.lit(None).cast("string")
    last = clean_name(_eval(spec.last_name_expr, "string")) if spec.last_name_expr else F.lit(None).cast("string")
    nat = clean_nationality(_eval(spec.nationality_expr, "string")) if spec.nationality_expr \
        else F.lit(None).cast("string")
    return (df.where(F.coalesce(keep, F.lit(False)))
            .select(F.lower(F.trim(e1)).alias("email"),
                    F.coalesce(F.expr(spec.key_expr).cast("string"), F.lit("")).alias("_pk"),
                    first.alias("first_name"), last.alias("last_name"),
                    nat.alias("nationality"),
                    clean_birthday(bday, as_of).alias("birthday"),
                    tags.alias("tags"),
                    _eval(spec.allow_email_expr, "boolean").cast("boolean").alias("allow_email"),
                    F.array(F.lit(spec.source_table)).alias("sources"),
                    F.lit(None).cast("boolean").alias("needs_push"),
                    *[F.lit(None).cast(t).alias(c) for c, t in _CARRY]))


REGISTRY_COLUMNS = ["source_table", "email_expr", "first_name_expr", "last_name_expr", "nationality_expr", "birthday_expr", "source_tag",
                    "extra_tags_expr", "allow_email_expr", "where_extra", "priority", "enabled", "key_expr"]
REGISTRY_SCHEMA = ", ".join(f"{c} {'int' if c == 'priority' else 'boolean' if c == 'enabled' else 'string'}" for c in REGISTRY_COLUMNS)


def registry_table(spark, specs=None) -> DataFrame:
    """The registry as a table, one row per source."""
    specs = C.DEFAULT_REGISTRY if specs is None else specs
    return spark.createDataFrame([tuple(getattr(s, c) for c in REGISTRY_COLUMNS) for s in specs], REGISTRY_SCHEMA)


def specs_from_table(registry: DataFrame, most: int = 1000) -> list[SourceSpec]:
    """The sources of a registry table (configuration: more than ``most`` rows
    are refused).  Absent optional columns and NULL cells take their defaults."""
    rows = registry.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the registry holds more than {most} sources")
    return [SourceSpec(**{c: r[c] for c in REGISTRY_COLUMNS if c in registry.columns and r[c] is not None}) for r in rows]


def dedupe_within_source(canonical: DataFrame) -> DataFrame:
    """One row per email within one source: the row with the smallest key."""
    cols = [c for c in canonical.columns if c != "email"]
    return (canonical.groupBy("email")
            .agg(F.min_by(F.struct(*cols), F.col("_pk")).alias("_r"))
            .select("email", "_r.*"))


# ---------------------------------------------------------------------------
# Merge (full rebuild and incremental refresh)
# ---------------------------------------------------------------------------
@dataclass
class MergeResult:
    master: DataFrame          # merged rows incl. change flags (_applied_<i>, _changed)
    present: list              # [(rank, SourceSpec)] of sources that exist
    missing: list              # [SourceSpec] whose table is absent


_STRUCT_COLS = FIELDS + ["tags", "sources", "needs_push"]
_CARRY = [("last_pushed_at", "timestamp_ntz"), ("push_status", "string")]


def _prior_rows(prior: DataFrame) -> DataFrame:
    return prior.select(
        "email", F.col("email").alias("_pk"), "first_name", "last_name", "nationality",
        F.col("birthday").cast("date").alias("birthday"), "tags",
        F.col("allow_email").cast("boolean").alias("allow_email"),
        F.coalesce(F.col("sources"), _empty()).alias("sources"),
        F.col("needs_push").cast("boolean").alias("needs_push"),
        *[(F.col(c) if c in prior.columns else F.lit(None)).cast(t).alias(c) for c, t in _CARRY])


def store_keyed(df: DataFrame, table: str, path: str, key: str = "email", buckets: int | None = None) -> DataFrame:
    """Write a table bucketed and sorted by its key.  A merge that deals its
    sources into as many partitions (``spark.sql.shuffle.partitions``) then reads
    this side where it lies, without a shuffle."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def merge_sources(sources: dict, registry=None, prior: DataFrame | None = None,
                  as_of: _dt.date = C.AS_OF, exclude: DataFrame | None = None,
                  dims: Dimensions | None = None, keyed_prior: bool = False) -> MergeResult:
    """Fold all sources (and the prior master) into one row per email.

    Equivalent to merging source by source in (priority, source_table)
    order with "fill only NULL fields, union tags and sources, touch the
    row only when something is gained".  The prior row outranks every
    source.  ``keyed_prior`` says that no address is repeated in the prior master:
    it is then joined to the merged sources by address instead of being grouped
    with them, and one stored by ``store_keyed`` is not shuffled.
    """
    specs = ordered_specs(registry)
    present = [(i + 1, s) for i, s in enumerate(specs) if sources.get(s.source_table) is not None]
    missing = [s for s in specs if sources.get(s.source_table) is None]
    parts = []
    joined = prior is not None and keyed_prior and bool(present)
    if prior is not None and not joined:
        parts.append(_prior_rows(prior).withColumn("_rank", F.lit(0)))
    for rank, spec in present:
        parts.append(registry_project(sources[spec.source_table], spec, as_of, dims)
                     .withColumn("_rank", F.lit(rank)))
    if not parts:
        raise ValueError("no source tables and no prior master")
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)

    ranks = ([0] if prior is not None and not joined else []) + [r for r, _ in present]
    row = F.struct(*[F.col(c) for c in _STRUCT_COLS + [c for c, _ in _CARRY]])
    aggs = [F.min_by(row, F.when(F.col("_rank") == r, F.col("_pk"))).alias(f"_c{r}") for r in ranks]
    per_email = union.groupBy("email").agg(*aggs)
    if joined:
        held = _prior_rows(prior).select(F.col("email").alias("_held"), row.alias("_c0"))
        per_email = per_email.join(held, F.col("email") == F.col("_held"), "full").select(
            F.coalesce("email", "_held").alias("email"), "_c0", *[f"_c{r}" for r in ranks])
    if exclude is not None:
        # After the aggregation every email is one row, so the anti-join
        # shuffles no hot key.
        per_email = per_email.join(exclude.select("email").distinct(), "email", "left_anti")

    if prior is None:
        return MergeResult(_flat_merge(per_email, present), present, missing)

    # The merge is a left fold over the per-source structs in rank order,
    # written as one ``aggregate`` higher-order function: the state is bound
    # once per step, so the expression does not grow with the number of
    # sources.  The prior row is the initial state.
    c0 = F.col("_c0")
    init = F.struct(c0.isNotNull().alias("exists"),
                    *[c0[f].alias(f) for f in FIELDS],
                    c0["tags"].alias("tags"), c0["sources"].alias("sources"),
                    c0["needs_push"].alias("needs_push"),
                    F.array().cast("array<boolean>").alias("applied")).cast(_STATE_TYPE)

    def step(st, c):
        gain = F.lit(False)
        for f in FIELDS:
            gain = gain | (st[f].isNull() & c[f].isNotNull())
        gain = (gain
                | (F.size(F.array_except(c["tags"], F.coalesce(st["tags"], _empty()))) > 0)
                | (F.size(F.array_except(c["sources"], F.coalesce(st["sources"], _empty()))) > 0))
        applied = c.isNotNull() & (~st["exists"] | gain)
        return F.struct(
            (st["exists"] | c.isNotNull()).alias("exists"),
            *[F.when(applied, F.coalesce(st[f], c[f])).otherwise(st[f]).alias(f) for f in FIELDS],
            F.when(applied, clean_tags(F.concat(F.coalesce(st["tags"], _empty()), c["tags"])))
             .otherwise(st["tags"]).alias("tags"),
            F.when(applied, F.array_distinct(F.concat(F.coalesce(st["sources"], _empty()), c["sources"])))
             .otherwise(st["sources"]).alias("sources"),
            F.when(applied, F.lit(True)).otherwise(st["needs_push"]).alias("needs_push"),
            F.concat(st["applied"], F.array(applied)).alias("applied")).cast(_STATE_TYPE)

    src_structs = F.array(*[F.col(f"_c{r}") for r, _ in present]) if present \
        else F.array().cast(f"array<{_SRC_TYPE}>")
    folded = per_email.select("email", c0, F.aggregate(src_structs, init, step).alias("_m"))
    m = F.col("_m")
    extra = [F.get(m["applied"], i).alias(f"_applied_{r}") for i, (r, _) in enumerate(present)]
    extra += [c0.isNotNull().alias("_had_prior"), c0["birthday"].alias("_prior_birthday")]
    applied_any = F.coalesce(F.array_contains(m["applied"], True), F.lit(False))
    out = folded.select(
        "email",
        *[m[f].alias(f) for f in FIELDS],
        m["tags"].alias("tags"),
        F.array_sort(m["sources"]).alias("sources"),
        F.coalesce(m["needs_push"], F.lit(True)).alias("needs_push"),
        applied_any.alias("_changed"),
        *[c0[c].alias(c) for c, _ in _CARRY],
        *extra)
    return MergeResult(out, present, missing)


def _flat_merge(per_email: DataFrame, present) -> DataFrame:
    """The fold without a prior master, in closed form.

    With no prior row every source brings a source label the state lacks,
    so every present source is applied: fields are the first non-null in
    rank order, tags the ordered distinct concatenation (each source's tags
    are already clean), sources the set of labels, needs_push true.
    """
    cs = [F.col(f"_c{r}") for r, _ in present]
    tags = F.array_distinct(F.concat(*[F.coalesce(c["tags"], _empty()) for c in cs]))
    srcs = F.array_sort(F.array_distinct(F.concat(*[F.coalesce(c["sources"], _empty()) for c in cs])))
    return per_email.select(
        "email",
        *[F.coalesce(*[c[f] for c in cs]).alias(f) for f in FIELDS],
        F.when(F.size(tags) > 0, tags).alias("tags"),
        srcs.alias("sources"),
        F.lit(True).alias("needs_push"),
        F.lit(True).alias("_changed"),
        *[F.lit(None).cast(t).alias(c) for c, t in _CARRY],
        *[c.isNotNull().alias(f"_applied_{r}") for c, (r, _) in zip(cs, present)])


_SRC_TYPE = ("struct<first_name:string,last_name:string,nationality:string,birthday:date,"
             "allow_email:boolean,tags:array<string>,sources:array<string>,needs_push:boolean,"
             "last_pushed_at:timestamp_ntz,push_status:string>")
_STATE_TYPE = ("struct<exists:boolean,first_name:string,last_name:string,nationality:string,"
               "birthday:date,allow_email:boolean,tags:array<string>,sources:array<string>,"
               "needs_push:boolean,applied:array<boolean>>")


def refresh_counts(result: MergeResult) -> DataFrame:
    """Rows inserted or really updated per source, in merge order; -1 = missing table.

    One aggregate over the merged rows (no extra shuffle: a global count).
    """
    spark = result.master.sparkSession
    specs = ordered_specs_from(result)
    if result.present:
        aggs = [F.count_if(F.col(f"_applied_{r}")).alias(f"n{r}") for r, _ in result.present]
        one = result.master.agg(*aggs)
        stack_args = ", ".join(f"'{s.source_table}', CAST(n{r} AS BIGINT)" for r, s in result.present)
        counted = one.selectExpr(f"stack({len(result.present)}, {stack_args}) AS (source, rows_merged)")
    else:
        counted = spark.createDataFrame([], "source string, rows_merged bigint")
    if result.missing:
        absent = spark.createDataFrame([(s.source_table, -1) for s in result.missing],
                                       "source string, rows_merged bigint")
        counted = counted.unionByName(absent)
    order = {s.source_table: i for i, s in enumerate(specs)}
    order_col = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    return counted.withColumn("merge_order", F.element_at(order_col, F.col("source")))


def ordered_specs_from(result: MergeResult):
    return sorted([s for _, s in result.present] + list(result.missing),
                  key=lambda s: (s.priority, s.source_table))


def refresh_changed(result: MergeResult) -> DataFrame:
    """email, needs_push and whether the run inserted/updated the row."""
    m = result.master
    had = F.col("_had_prior") if "_had_prior" in m.columns else F.lit(False)
    change = (F.when(~had, F.lit("inserted"))
              .when(F.col("_changed"), F.lit("updated")).otherwise(F.lit("unchanged")))
    return m.select("email", "needs_push", change.alias("change"))


# ---------------------------------------------------------------------------
# Minors
# ---------------------------------------------------------------------------
LEDGER_COLUMNS = ["email", "source_table", "excluded_at"]


def record_minors(sources: dict, registry=None, ledger: DataFrame | None = None,
                  as_of: _dt.date = C.AS_OF, run_ts: _dt.datetime = C.RUN_TS) -> tuple[DataFrame, DataFrame]:
    """Ledger of under-age emails: (new ledger, newly added rows).

    Raw lower/trim email and source name only; no format/blocked/extra
    filter.  An email seen under age in several sources is recorded for the
    first source in merge order; emails already in the ledger are skipped.
    """
    specs = [s for s in ordered_specs(registry)
             if s.birthday_expr is not None and sources.get(s.source_table) is not None]
    spark = next(iter(v for v in sources.values() if v is not None)).sparkSession
    if not specs:
        empty = spark.createDataFrame([], "email string, source_table string, excluded_at timestamp_ntz")
        return (ledger if ledger is not None else empty), empty
    register_rules(spark, None, as_of)
    parts = []
    for rank, spec in enumerate(specs):
        e = _eval(spec.email_expr, "string")
        bday = _eval(spec.birthday_expr, "date")
        cond = e.isNotNull() & (F.trim(e) != "") & bday.isNotNull() & ~is_adult(bday, as_of)
        parts.append(sources[spec.source_table].where(F.coalesce(cond, F.lit(False)))
                     .select(F.lower(F.trim(e)).alias("email"),
                             F.lit(spec.source_table).alias("source_table"),
                             F.lit(rank).alias("_rank")))
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    firsts = cand.groupBy("email").agg(F.min_by("source_table", "_rank").alias("source_table"))
    if ledger is not None:
        firsts = firsts.join(ledger.select("email"), "email", "left_anti")
    new = firsts.select("email", "source_table",
                        ts_ntz(run_ts).alias("excluded_at"))
    full = new if ledger is None else ledger.select(*LEDGER_COLUMNS).unionByName(new)
    return full, new


def purge_minors(master: DataFrame, as_of: _dt.date = C.AS_OF) -> tuple[DataFrame, DataFrame]:
    """(kept rows, removed rows): rows whose stored birthday is under age."""
    adult = is_adult(F.col("birthday"), as_of)
    return master.where(adult), master.where(~adult)


# ---------------------------------------------------------------------------
# Dimensions and duplicates
# ---------------------------------------------------------------------------
def split_dimensions(master: DataFrame, country_tags=None, source_tags=None, brands=None) -> DataFrame:
    """First tag of each class; the venue is the first tag of no class."""
    country_tags = list(C.COUNTRY_MAP.values()) if country_tags is None else list(country_tags)
    source_tags = C.SOURCE_TAGS if source_tags is None else list(source_tags)
    brands = C.BRANDS if brands is None else list(brands)
    t = F.col("tags")
    return (master
            .withColumn("src_system", first_tag_in(t, source_tags))
            .withColumn("brand", first_tag_in(t, brands))
            .withColumn("country", first_tag_in(t, country_tags))
            .withColumn("venue", first_tag_not_in(t, source_tags + brands + country_tags)))


def dimension_counts(master: DataFrame) -> DataFrame:
    return master.agg(F.count_if(F.col("brand").isNotNull()).cast("long").alias("with_brand"),
                      F.count_if(F.col("venue").isNotNull()).cast("long").alias("with_venue"))


def find_duplicates(master: DataFrame) -> DataFrame:
    """Mark records reaching the same inbox as another, keeping the most
    complete (then shortest, then alphabetical) address per inbox key.

    Markers are recomputed from scratch; a marked duplicate gets
    ``needs_push = false`` (an unmarked one keeps its flag).
    """
    keyed = master.withColumn("email_key", inbox_key(F.col("email")))
    completeness = (F.col("first_name").isNotNull().cast("int") + F.col("last_name").isNotNull().cast("int")
                    + F.col("birthday").isNotNull().cast("int"))
    rank = F.struct((-completeness).alias("c"), F.length("email").alias("l"), F.col("email").alias("e"))
    keepers = (keyed.where(F.col("email_key").isNotNull())
               .groupBy("email_key").agg(F.min_by(F.col("email"), rank).alias("_keeper")))
    j = keyed.join(keepers, "email_key", "left")
    dup = F.col("_keeper").isNotNull() & (F.col("_keeper") != F.col("email"))
    return (j.withColumn("duplicate_of", F.when(dup, F.col("_keeper")))
            .withColumn("dup_reason", F.when(dup, F.concat(F.lit("same inbox as "), F.col("_keeper"))))
            .withColumn("needs_push", F.when(dup, F.lit(False)).otherwise(F.col("needs_push")))
            .drop("_keeper"))


def duplicate_counts(master: DataFrame) -> DataFrame:
    dup = F.col("duplicate_of").isNotNull()
    return master.agg(F.count_if(dup).cast("long").alias("duplicates"),
                      F.count_distinct(F.when(dup, F.col("email_key"))).cast("long").alias("people_affected"))


def possible_duplicates(master: DataFrame) -> DataFrame:
    """Groups of non-duplicate records sharing first + last name + birthday.

    One row per group with its size and first address; the member list is
    ``possible_duplicate_members`` (rows, not an array: a group may be huge).
    """
    base = master.where(F.col("duplicate_of").isNull() & F.col("first_name").isNotNull()
                        & F.col("last_name").isNotNull())
    g = base.groupBy(F.lower(F.trim("first_name")).alias("first_name"),
                     F.lower(F.trim("last_name")).alias("last_name"), F.col("birthday"))
    return g.agg(F.count(F.lit(1)).alias("records"), F.min("email").alias("first_email")) \
        .where(F.col("records") > 1)


def possible_duplicate_members(master: DataFrame) -> DataFrame:
    groups = possible_duplicates(master)
    base = master.where(F.col("duplicate_of").isNull() & F.col("first_name").isNotNull()
                        & F.col("last_name").isNotNull()) \
        .select(F.lower(F.trim("first_name")).alias("first_name"),
                F.lower(F.trim("last_name")).alias("last_name"), "birthday", "email")
    g = groups.select(F.col("first_name").alias("_f"), F.col("last_name").alias("_l"),
                      F.col("birthday").alias("_b"), "records")
    on = (F.col("first_name") == F.col("_f")) & (F.col("last_name") == F.col("_l")) \
        & F.col("birthday").eqNullSafe(F.col("_b"))
    return base.join(g, on, "inner").select("first_name", "last_name", "birthday", "records", "email")


# ---------------------------------------------------------------------------
# The whole rebuild
# ---------------------------------------------------------------------------
@dataclass
class Rebuild:
    master: DataFrame
    ledger: DataFrame
    new_minors: DataFrame
    removed: DataFrame
    counts: DataFrame
    merge: MergeResult


def rebuild_pipeline(sources: dict, registry=None, prior: DataFrame | None = None,
                     ledger: DataFrame | None = None, as_of: _dt.date = C.AS_OF,
                     run_ts: _dt.datetime = C.RUN_TS, materialize: bool = True,
                     strict_minors: bool = False, dims: Dimensions | None = None, keyed_prior: bool = False) -> Rebuild:
    """refresh -> minors -> dimensions -> duplicates.

    With ``materialize`` the merged rows, with their change flags, are
    written once as Parquet in the shared folder before anything branches off
    them: kept and removed rows, counts, dimensions and the duplicate pass
    (whose keeper aggregate reads four columns) all read that copy.
    """
    full_ledger, new_minors = record_minors(sources, registry, ledger, as_of, run_ts)
    exclude = None
    if strict_minors:
        # Keep every ledger address out, compared on the corrected key
        # (the ledger holds the raw lower/trim address).
        exclude = full_ledger.select(F.lower(F.trim(fix_domain(F.col("email"), (dims or Dimensions()).corrections))).alias("email"))
    res = merge_sources(sources, registry, prior, as_of, exclude=exclude, dims=dims, keyed_prior=keyed_prior)
    if materialize:
        root = ensure_checkpoint_dir(res.master.sparkSession).rstrip("/")
        path = f"{root}/merged/{uuid.uuid4().hex}"
        res.master.write.parquet(path)
        res.master = res.master.sparkSession.read.schema(res.master.schema).parquet(path)
    merged = res.master
    # Source birthdays have passed the age gate, so a stored birthday can
    # only be under age when it came from the prior row (which outranks the
    # sources): testing the prior birthday is the same as testing the
    # merged one, and keeps the fold out of the pushed-down filter.
    if prior is not None:
        adult = is_adult(F.col("_prior_birthday"), as_of)
        kept, removed = merged.where(adult), merged.where(~adult)
    else:
        kept, removed = merged, merged.where(F.lit(False))
    split = split_dimensions(kept)
    master = find_duplicates(split).select(*MASTER_COLUMNS)
    return Rebuild(master, full_ledger, new_minors, removed, refresh_counts(res), res)


def rebuild_metrics(rb: Rebuild) -> DataFrame:
    """One row: newly excluded minors, rows purged, dimension and duplicate counts."""
    out = dimension_counts(rb.master)
    dup = duplicate_counts(rb.master)
    for c in dup.columns:
        out = out.withColumn(c, dup.select(c).scalar())
    out = out.withColumn("newly_excluded", rb.new_minors.agg(F.count(F.lit(1))).scalar()) \
        .withColumn("removed_from_master", rb.removed.agg(F.count(F.lit(1))).scalar())
    return out.select("newly_excluded", "removed_from_master", "with_brand", "with_venue",
                      "duplicates", "people_affected")
