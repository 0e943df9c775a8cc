"""Streaming signups equal the batch fold, also when a batch is replayed."""

from pyspark.sql import functions as F

from custfold.operators import ingest
from custfold.sources.fixtures import fixture
from custfold.streaming.signups import run_signup_stream

from conftest import MEDIUM

COLS = ["email", "brand", "country", "site", "page", "first_name", "last_name", "signed_up_at"]


def test_stream_equals_batch(spark):
    events = fixture(spark, MEDIUM, "signup_events")
    batch = ingest.newsletter_signups(events).select(*COLS)
    stream = run_signup_stream(spark, events, n_files=4).select(*COLS)
    assert sorted(batch.collect()) == sorted(stream.collect())


def test_replayed_batch_changes_nothing(spark):
    events = fixture(spark, MEDIUM, "signup_events")
    acc = ingest.accept_signups(events)
    part1 = ingest.signup_state(acc.where(F.col("seq") % 2 == 0), batch=0)
    part2 = ingest.signup_state(acc.where(F.col("seq") % 2 == 1), batch=0)
    once = ingest.merge_signup_states(part1, part2)
    twice = ingest.merge_signup_states(ingest.merge_signup_states(once, part2), part1)
    a = ingest.signups_from_state(once).select(*COLS)
    b = ingest.signups_from_state(twice).select(*COLS)
    assert sorted(a.collect()) == sorted(b.collect())
