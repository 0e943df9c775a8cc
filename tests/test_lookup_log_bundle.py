"""Point lookup, run log and the report bundle: plans and cases."""

import datetime as dt
import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from custfold.operators import lookup, master, runlog
from custfold.plans import pipeline, reports
from custfold.sources.fixtures import fixture

from conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_pushes_the_address_and_returns_whole_rows(spark, tmp_path):
    rows = [(i, f"User{i % 50}@X.com" if i % 7 else None, i * 1.5, dt.date(2024, 1, 1 + i % 9), [f"t{i}"]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, email string, score double, day date, tags array<string>")
    table = lookup.store_lookup(df, str(tmp_path / "t"))
    got = lookup.lookup(table, [" user3@x.COM", "", None, "none@x.com"])
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, df.where("lower(email) = 'user3@x.com'").collect()))
    assert "PushedFilters: [In(lookup_email" in plan_of(got) or "PushedFilters: [EqualTo(lookup_email" in plan_of(got) or "In(lookup_email" in plan_of(got).split("PushedFilters")[1]
    files = sorted(glob.glob(str(tmp_path / "t/*.parquet")))
    spans = []
    for f in files:
        emails = [e for e in pq.read_table(f, columns=["lookup_email"])["lookup_email"].to_pylist() if e is not None]
        assert emails == sorted(emails)
        if emails:
            spans.append((emails[0], emails[-1]))
    assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert lookup.lookup(table, []).count() == 0
    with pytest.raises(ValueError):
        lookup.lookup(table, [f"{i}@x.com" for i in range(1001)])


def test_hot_address_is_spread_over_files(spark, tmp_path):
    df = spark.range(20_000).select(F.lit("hot@x.com").alias("email"), "id").repartition(8)
    key, old = "spark.sql.adaptive.coalescePartitions.enabled", spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set(key, "false")  # as at a size at which no partition is small
        lookup.store_lookup(df, str(tmp_path / "h"))
    finally:
        spark.conf.set(key, old)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(str(tmp_path / "h/*.parquet"))]
    assert len(sizes) >= 4 and max(sizes) < 10_000


def test_log_rows_of_good_and_failed_runs(spark, tmp_path):
    log = str(tmp_path / "log")
    raw = fixture(spark, SMALL, "revel_raw")
    found = runlog.ingest_pos_logged(spark, raw, str(tmp_path / "pos"), log)
    assert found["rows"] == found["ok"] + found["rejected"] + found["discarded"]
    assert spark.read.parquet(str(tmp_path / "pos")).count() == found["ok"] + found["rejected"]
    with pytest.raises(Exception, match="already exists"):
        runlog.ingest_pos_logged(spark, raw, str(tmp_path / "pos"), log)
    rows = {r["status"]: r for r in spark.read.parquet(log).collect()}
    assert json.loads(rows["ok"]["metrics"]) == found and rows["failed"]["error"] and rows["failed"]["metrics"] == "{}"
    assert all(r["started_at"] <= r["finished_at"] for r in rows.values())


def test_counts_come_from_the_writing_pass(spark, tmp_path):
    df = fixture(spark, SMALL, "revel_raw")
    seen = runlog.write_observed(df, str(tmp_path / "w"), {"n": F.count(F.lit(1)), "with_email": F.count("email")})
    back = spark.read.parquet(str(tmp_path / "w"))
    assert seen == {"n": back.count(), "with_email": back.where("email IS NOT NULL").count()}


def test_bundle_reads_the_master_once(spark):
    m = pipeline.stored_master(spark, SMALL)
    plan = plan_of(reports.report_bundle(m))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_registry_cells_are_plain_sql(spark, tmp_path):
    specs = master.specs_from_table(master.registry_table(spark))
    assert specs == master.C.DEFAULT_REGISTRY
    assert all("market:" not in (s.extra_tags_expr or "") for s in specs)
    with pytest.raises(ValueError):
        master.specs_from_table(master.registry_table(spark), most=2)
    df = spark.createDataFrame([("1", "a@x.com", "pickl-jordan-vista", "2000-01-01")], "pk string, e string, market string, dob string")
    own = spark.createDataFrame([("s", "lower(e)", "S", "array_append(parse_market(market), 'extra')", "parse_birthday(dob)", "pk")],
                                "source_table string, email_expr string, source_tag string, extra_tags_expr string, birthday_expr string, key_expr string")
    got = master.merge_sources({"s": df}, registry=master.specs_from_table(own)).master.collect()
    assert [(r.email, r.tags, r.birthday) for r in got] == [("a@x.com", ["S", "PICKL", "JORDAN", "VISTA", "EXTRA"], dt.date(2000, 1, 1))]
