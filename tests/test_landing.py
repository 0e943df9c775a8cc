"""Landed feed: the incremental slice prunes by brand and period at run time."""

import datetime as dt

from pyspark.sql import functions as F

from custfold.operators import ingest, landing
from custfold.plans import queries_ingest as Q
from custfold.sources.fixtures import fixture

from conftest import SMALL


def test_slice_prunes_folders(spark):
    df = Q.q_incremental_slice_landed(spark, SMALL)
    rows = sorted(tuple(r) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "feed_period" in x and "rows" not in x)
    filters = scan[scan.index("PartitionFilters"):]
    assert "dynamicpruning" in filters.lower()
    assert "feed_brand" in filters and "feed_period" in filters
    want = ingest.incremental_slice(fixture(spark, SMALL, "revel_raw"), Q._sync_state(spark, SMALL)).select("_seq", "_brand", "email", "updated_date")
    assert rows == sorted(tuple(r) for r in want.collect())


def test_only_wanted_folders(spark, tmp_path):
    feed = spark.createDataFrame([("A", f"a{m}@x.com", f"2024-{m:02d}-10 00:00:00") for m in range(1, 7)]
                                 + [("A", "old@x.com", "bad"), ("B", "b@x.com", "2020-01-01 00:00:00"), ("B", "c@x.com", None), ("C", "d@x.com", "2024-01-01 00:00:00")],
                                 "_brand string, email string, updated_date string")
    state = spark.createDataFrame([("A", True, dt.datetime(2024, 5, 1)), ("B", False, dt.datetime(2024, 5, 1)), ("C", True, None)],
                                  "brand string, backfill_complete boolean, watermark timestamp_ntz")
    landing.land(feed, str(tmp_path / "feed"))
    landed = spark.read.parquet(str(tmp_path / "feed"))
    periods = landing.landed_periods(landed)
    assert periods.agg(F.sum("rows")).first()[0] == 10
    wanted = {(r[0], r[1]) for r in landing.wanted_periods(periods, state).collect()}
    assert wanted == {("A", "2024-04"), ("A", "2024-05"), ("A", "2024-06"), ("B", "2020-01"), ("B", "none"), ("C", "2024-01")}
    got = landing.slice_landed(landed, periods, state)
    assert sorted(r.email for r in got.collect()) == ["a5@x.com", "a6@x.com", "b@x.com", "c@x.com", "d@x.com"]
    assert got.columns == ["_brand", "email", "updated_date"]
    want = ingest.incremental_slice(feed, state)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
