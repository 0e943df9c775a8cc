"""Golden cases for the push outcome rules and the push plan arithmetic."""

import datetime as dt

from custfold.operators import activate as A

OK_CREATE = '{"status":"ok","membership":{"comoMemberId":"n1","commonExtId":"x1"}}'
NOT_FOUND = '{"status":"error","errors":[{"code":"4001012"}]}'
EXISTS = '{"status":"error","errors":[{"code":"4000","cause":[{"code":4000000}]}]}'
OTHER = '{"status":"error","errors":[{"code":"9999999"}]}'
BOTH = '{"status":"error","errors":[{"code":"4000000","cause":[{"code":"4001012"}]}]}'


def _responses(spark, rows):
    return spark.createDataFrame(rows, "email string, brand string, mode string, lookup_body string, "
                                       "create_body string, update_body string")


def test_create_mode(spark):
    rows = [("a", "PICKL", "create", '{"status":"ok","membership":{"comoMemberId":"m1"}}', None, None),
            ("b", "PICKL", "create", None, OK_CREATE, None),
            ("c", "PICKL", "create", NOT_FOUND, OK_CREATE, None),
            ("d", "PICKL", "create", NOT_FOUND, EXISTS, None),
            ("e", "PICKL", "create", NOT_FOUND, OTHER, None),
            ("f", "PICKL", "create", NOT_FOUND, None, None)]
    got = {r.email: r for r in A.push_outcome_create(_responses(spark, rows)).collect()}
    assert (got["a"].status, got["a"].detail, got["a"].como_member_id) == ("exists", "already in Como - left alone", "m1")
    assert (got["b"].status, got["b"].detail) == ("failed", "couldn't check whether they exist")
    assert (got["c"].status, got["c"].detail, got["c"].common_ext_id) == ("ok", "created", "x1")
    assert (got["d"].status, got["d"].detail) == ("exists", "already in Como")
    assert got["e"].status == "failed"
    assert got["e"].detail == '{"status": "error", "errors": [{"code": "9999999"}]}'
    assert (got["f"].status, got["f"].detail) == ("failed", "null")


def test_update_mode_checks_not_found_first(spark):
    rows = [("a", "B", "update", None, None, '{"status":"ok"}'),
            ("b", "B", "update", None, OK_CREATE, BOTH),
            ("c", "B", "update", None, EXISTS, NOT_FOUND),
            ("d", "B", "update", None, None, '{"status":"error","errors":[{"code":"4000000"}]}'),
            ("e", "B", "update", None, None, None)]
    got = {r.email: r for r in A.push_outcome_update(_responses(spark, rows)).collect()}
    assert (got["a"].status, got["a"].detail, got["a"].como_member_id) == ("ok", "updated", None)
    assert (got["b"].status, got["b"].detail, got["b"].como_member_id) == ("ok", "created", "n1")
    assert got["c"].status == "conflict"
    assert got["d"].status == "conflict"
    assert (got["e"].status, got["e"].detail) == ("failed", "null")


def test_record_push_state_keeps_ids(spark):
    state = spark.createDataFrame([("a", "PICKL", "ok", "created", "m1", "x1", dt.datetime(2024, 1, 1))],
                                  "email string, brand string, status string, detail string, como_member_id string, "
                                  "common_ext_id string, last_pushed_at timestamp_ntz")
    out = spark.createDataFrame([("a", "PICKL", "exists", "d" * 600, None, None)],
                                "email string, brand string, status string, detail string, como_member_id string, "
                                "common_ext_id string")
    r = A.record_push_state(state, out).collect()[0]
    assert (r.status, len(r.detail), r.como_member_id, r.common_ext_id) == ("exists", 500, "m1", "x1")


def test_push_plan_text(spark):
    schema = "email string, tags array<string>, duplicate_of string"
    master = spark.createDataFrame([(f"u{i}@x.com", ["WIFI", "PICKL"], None) for i in range(100)], schema)
    state = spark.createDataFrame([("u0@x.com", "BONBIRD", "ok")], "email string, brand string, status string")
    r = A.push_plan(master, state, "ALL", rate=0, batch_size=10, batch_pause=60).collect()[0]
    # 99 queued -> 148 calls at 0.5 s = 74 s, plus 9 pauses of 60 s = 614 s
    assert (r.queued, r.api_calls, r.batches, r.seconds, r.rate, r.over_limit) == (99, 148, 10, 614, 120, False)
    assert r.human == "10 min"
    r2 = A.push_plan(master, None, "PICKL", rate=600).collect()[0]
    assert (r2.queued, r2.over_limit, r2.human) == (0, True, "0 sec")


def test_record_push_state_last_attempt_wins(spark):
    state = spark.createDataFrame([], "email string, brand string, status string, detail string, "
                                      "como_member_id string, common_ext_id string, last_pushed_at timestamp_ntz")
    log = spark.createDataFrame([("a", "PICKL", "failed", "boom", None, None, 1),
                                 ("a", "PICKL", "ok", "created", "m9", None, 2),
                                 ("a", "PICKL", "exists", "already in Como", None, None, 3)],
                                "email string, brand string, status string, detail string, como_member_id string, "
                                "common_ext_id string, attempt int")
    rows = A.record_push_state(state, log, order_col="attempt").collect()
    # last attempt's status; the id from attempt 2 is not replaced by NULL
    assert len(rows) == 1 and rows[0].status == "exists" and rows[0].como_member_id == "m9"
