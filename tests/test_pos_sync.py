"""The feed load as a stream: committed epochs, replay, resume, end state."""

import datetime as dt

import pytest

from custfold import config as C
from custfold.operators import ingest
from custfold.streaming import epochs
from custfold.streaming.pos_sync import next_state, read_pos_table, read_sync_state, run_interrupted_sync, sync_epoch, start_pos_sync

FEED = "_seq long, resource_uri string, _brand string, first_name string, last_name string, email string, email_opt_in boolean, updated_date string"


def feed(spark, seqs, total=6):
    rows = [(i, f"/c/{i % 4}/", "A" if i % 2 else "B", "Ana", None, f"u{i}@x.com" if i % 5 else "staff@grubtech.com", True, f"2024-01-{i + 1:02d} 00:00:00") for i in seqs]
    return spark.createDataFrame([(*r, total) for r in rows], FEED + ", _total long")


def state_of(df):
    return {r.brand: (r.backfill_offset, r.backfill_complete, r.watermark) for r in df.collect()}


def test_interrupted_run_ends_like_one_shot(spark):
    one = feed(spark, range(24)).drop("_total")
    rows, half, last = run_interrupted_sync(spark, one)
    want = ingest.revel_customers(one)
    assert sorted(map(tuple, rows.select(*ingest.POS_COLUMNS).collect())) == sorted(map(tuple, want.select(*ingest.POS_COLUMNS).collect()))
    # The pages of the first half hold the numbers 0, 1, 2 modulo 6; the cut-off epoch counts once.
    assert state_of(half) == {"A": (4, False, dt.datetime(2024, 1, 20)), "B": (8, False, dt.datetime(2024, 1, 21))}
    assert state_of(last) == {"A": (0, True, dt.datetime(2024, 1, 24)), "B": (0, True, dt.datetime(2024, 1, 23))}


def test_uncommitted_epoch_is_not_read_and_replay_counts_once(spark, tmp_path):
    table = str(tmp_path / "t")
    sync_epoch(table)(feed(spark, [0, 1, 2, 3]), 0)

    def die(epoch):
        raise RuntimeError("cut")

    with pytest.raises(RuntimeError):
        sync_epoch(table, before_commit=die)(feed(spark, [4, 6]), 1)
    assert epochs.marked(spark, table, "epoch") == [0]
    before = state_of(read_sync_state(spark, table))
    assert before == {"A": (2, False, dt.datetime(2024, 1, 4)), "B": (2, False, dt.datetime(2024, 1, 3))}
    assert read_pos_table(spark, table).where("email = 'u4@x.com'").count() == 0
    for _ in range(2):  # the replay, and a replay of what is committed
        sync_epoch(table)(feed(spark, [4, 6]), 1)
    assert state_of(read_sync_state(spark, table))["B"] == (4, False, dt.datetime(2024, 1, 7))
    assert read_pos_table(spark, table).where("email = 'u4@x.com'").count() == 1


def test_complete_brand_stays_complete(spark):
    done = next_state(None, feed(spark, [1, 3, 5], total=3))
    later = next_state(done, feed(spark, [7], total=9), run_ts=C.RUN_TS)
    assert state_of(later) == {"A": (0, True, dt.datetime(2024, 1, 8))}


def test_stream_goes_on_from_offset(spark, tmp_path):
    src, table, chk = (str(tmp_path / x) for x in ("src", "t", "chk"))
    feed(spark, range(0, 8), total=6).write.parquet(src)
    schema = spark.read.parquet(src).schema
    start_pos_sync(spark, src, table, chk, schema).awaitTermination()
    assert {b: s[:2] for b, s in state_of(read_sync_state(spark, table)).items()} == {"A": (4, False), "B": (4, False)}
    feed(spark, range(8, 12), total=6).write.mode("append").parquet(src)
    start_pos_sync(spark, src, table, chk, schema).awaitTermination()
    assert {b: s[:2] for b, s in state_of(read_sync_state(spark, table)).items()} == {"A": (0, True), "B": (0, True)}
