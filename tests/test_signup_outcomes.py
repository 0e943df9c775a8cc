"""Signups and responses in one streaming state: any order, statuses kept, compaction."""

import itertools

from custfold import config as C
from custfold.operators import activate, ingest
from custfold.streaming import epochs
from custfold.streaming.signups import (compact_signup_table, read_signup_table, run_signup_outcome_stream, signups_with_outcomes,
                                        start_signup_stream)

EVENTS = "event_id long, ts timestamp_ntz, email string, site string, brand string, country string, first_name string, last_name string, page string"
RESPONSES = "email string, attempt int, create_body string, error_text string"
OK, TAKEN = '{"status":"ok"}', '{"status":"error","errors":[{"message":"member already exists"}]}'


def inputs(spark):
    e = [(i, C.RUN_TS, f"u{i % 4}@x.com", "pickl", None, None, f"N{i}" if i % 2 else None, None, "/p") for i in range(8)] + [(9, C.RUN_TS, "no-at", "pickl", *[None] * 5)]
    r = [("u0@x.com", 1, TAKEN, None), ("u0@x.com", 2, OK, None), ("u1@x.com", 1, None, "timed out"), ("u2@x.com", 3, TAKEN, None), ("stranger@x.com", 1, OK, None)]
    return spark.createDataFrame(e, EVENTS), spark.createDataFrame(r, RESPONSES)


def test_any_interleaving_gives_the_batch_table(spark):
    events, responses = inputs(spark)
    batch = activate.apply_signup_outcomes(ingest.newsletter_signups(events), activate.push_outcome_signup(responses))
    cols = ingest.SIGNUP_COLUMNS
    want = sorted(map(str, batch.select(*cols).collect()))
    s1, s2 = events.where("event_id < 3"), events.where("event_id >= 3")
    r1, r2 = responses.where("attempt = 1"), responses.where("attempt > 1")
    for parts in ([(events, responses)], [(None, r2), (s2, None), (None, r1), (s1, None)], [(s2, r1), (s1, r2)]):
        got = run_signup_outcome_stream(spark, parts)
        assert sorted(map(str, got.select(*cols).collect())) == want
    assert {r.email: r.como_status for r in batch.collect()} == {"u0@x.com": "ok", "u1@x.com": "failed", "u2@x.com": "exists", "u3@x.com": None}


def test_unmarked_epoch_is_not_read_and_compaction_removes(spark, tmp_path):
    events, responses = inputs(spark)
    src, rsp, table, chk = (str(tmp_path / x) for x in ("src", "rsp", "t", "chk"))
    responses.write.parquet(rsp)
    seen = []
    for i in itertools.count():
        part = events.where(f"event_id % 4 = {i}")
        part.write.mode("append").parquet(src)
        start_signup_stream(spark, src, table, chk, events.schema, responses_dir=rsp, responses_schema=responses.schema).awaitTermination()
        before = sorted(map(str, signups_with_outcomes(read_signup_table(spark, table)).collect()))
        compact_signup_table(spark, table)
        assert sorted(map(str, signups_with_outcomes(read_signup_table(spark, table)).collect())) == before
        seen.append(len(before))
        if i == 3:
            break
    assert seen == [1, 2, 3, 4]
    left = sorted(p.name.split("=")[0] for p in (tmp_path / "t").iterdir() if "=" in p.name)
    assert left.count("base") == 2 and left.count("epoch") < len(epochs.marked(spark, table, "epoch"))
    events.limit(1).write.parquet(f"{table}/epoch=000000099")  # written, never marked
    assert sorted(map(str, signups_with_outcomes(read_signup_table(spark, table)).collect())) == before
