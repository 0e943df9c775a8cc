"""Incremental slice and watermark rules on a small hand-made feed."""

import datetime as dt

from custfold.operators import ingest


def test_slice_and_watermark(spark):
    feed = spark.createDataFrame([
        ("A", "a@x.com", "2024-01-10 00:00:00"),   # after mark - 1 day: fetched
        ("A", "b@x.com", "2024-01-09 00:00:00"),   # exactly mark - 1 day: fetched
        ("A", "c@x.com", "2024-01-08 23:59:59"),   # before: skipped
        ("A", "no-at", "2024-01-11 00:00:00"),     # no @: never fetched
        ("B", "d@x.com", "2020-01-01 00:00:00"),   # B is backfilling: everything
        ("C", "e@x.com", "bad-date"),              # C unknown: backfill, date unparsable
    ], "_brand string, email string, updated_date string")
    state = spark.createDataFrame([
        ("A", 0, True, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10)),
        ("B", 500, False, dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 10)),
    ], "brand string, backfill_offset long, backfill_complete boolean, watermark timestamp_ntz, "
       "last_run_at timestamp_ntz")
    rows = ingest.incremental_slice(feed, state)
    assert sorted(r.email for r in rows.collect()) == ["a@x.com", "b@x.com", "d@x.com", "e@x.com"]
    new = {r.brand: r for r in ingest.advance_watermark(state, rows).collect()}
    assert new["A"].watermark == dt.datetime(2024, 1, 10)        # max(prior, newest)
    assert new["B"].watermark == dt.datetime(2023, 1, 1)         # newer prior mark kept
    assert new["C"].watermark is None                            # nothing parsable yet
    assert all(r.backfill_complete and r.backfill_offset == 0 for r in new.values())
