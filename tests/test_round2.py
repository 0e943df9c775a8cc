"""Rules mended in the second round: shared folder, plan building, documents
field by field, keyed state, text as Python prints it, editable dimensions."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from custfold import config as C
from custfold import session
from custfold.catalog import REGISTRY, load_all
from custfold.functions import email as E
from custfold.operators import activate as A
from custfold.operators import ingest
from custfold.operators import master as M
from custfold.plans import pipeline
from custfold.plans import reports as R
from custfold.sources.fixture_sql import FIXTURE_SQL
from custfold.sources.fixtures import fixture
from custfold.streaming import epochs
from custfold.streaming import signups as S

load_all()
#: These write a table or run a stream while they are built.
STORES = {"signup_stream", "refresh_master"}


def test_checkpoint_folder_is_stable_and_required_on_clusters(spark):
    first = session.ensure_checkpoint_dir(spark)
    assert session.ensure_checkpoint_dir(spark) == first
    assert session.is_local("local[8]") and not session.is_local("local-cluster[2,1,512]") and not session.is_local("yarn")

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:1"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_building_a_plan_runs_no_job(spark):
    pipeline.stored_master(spark, SMALL)
    pipeline.stored_master(spark, SMALL, True)
    pipeline.stored_sources(spark, SMALL)
    for name in FIXTURE_SQL:  # reading a table's schema is a job of its own, once per session
        fixture(spark, SMALL, name)
    sc, bad = spark.sparkContext, []
    stored = {n for n in REGISTRY if n.startswith("rebuild")} | STORES
    for name, (fn, _) in sorted(REGISTRY.items()):
        if name in stored:
            continue
        sc.setJobGroup(f"build-{name}", name)
        fn(spark, SMALL)
        if sc.statusTracker().getJobIdsForGroup(f"build-{name}"):
            bad.append(name)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not bad, bad


def test_stored_tables_follow_their_inputs(spark, tmp_path):
    spark.createDataFrame([(1,)], "event_id long").write.parquet(str(tmp_path / "events.parquet"))
    one = session.folder_version(spark, str(tmp_path))
    spark.createDataFrame([(1,), (2,)], "event_id long").write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    assert one and session.folder_version(spark, str(tmp_path)) != one


def test_inputs_grow_with_the_tables(spark):
    n = {s: [fixture(spark, d, t).count() for t in ("push_state", "run_log")] for s, d in (("s", SMALL), ("m", SMALL.replace("0.001", "0.01")))}
    assert all(b >= 8 * a for a, b in zip(n["s"], n["m"], strict=True)), n


def test_documents_field_by_field(spark):
    raw = spark.createDataFrame([(1, "d1", '{"Fname":"Ann","lname":"Lee"}'), (2, "d2", '{"Fname":"Bob"}')], "_seq long, doc_id string, body string")
    fields = ["fname", "lname", "visits", "meta"]
    t = ingest.upsert_docs_partial(None, ingest.docs_from_json(raw, fields), order_col="_seq")
    new = spark.createDataFrame([(1, "d1", '{"visits":3}'), (2, "d2", '{"Fname":null,"meta":{"a":[1]}}'), (3, "d2", '{"visits":1}'), (4, "d2", '{"visits":2,"lname":"Kay"}')],
                                "_seq long, doc_id string, body string")
    got = {r.doc_id: r for r in ingest.upsert_docs_partial(t, ingest.docs_from_json(new, fields), order_col="_seq").collect()}
    assert len(got) == 2
    assert (got["d1"].fname, got["d1"].lname, got["d1"].visits) == ("Ann", "Lee", "3")
    assert (got["d2"].fname, got["d2"].lname, got["d2"].visits, got["d2"].meta) == (None, "Kay", "2", '{"a":[1]}')


def test_new_fields_wait_for_a_value(spark):
    batch = spark.createDataFrame([("d1", None, None, "x"), ("d2", None, None, None)], "doc_id string, Empty string, a string, b string")
    batch = batch.toDF("doc_id", "Empty", "Note", "nOTE")
    assert ingest.fields_with_values(batch) == ["doc_id", "note"]
    out = ingest.ingest_docs_evolving(None, batch, fields=ingest.fields_with_values(batch))
    assert out.columns == ["doc_id", "note"] and sorted(r.note or "" for r in out.collect()) == ["", "x"]


def test_watermark_leaves_other_brands_alone(spark):
    state = spark.createDataFrame([("A", 0, True, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1)), ("B", 500, False, dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1))],
                                  ingest.SYNC_STATE_SCHEMA)
    rows = spark.createDataFrame([("A", "2024-03-01 00:00:00")], "_brand string, updated_date string")
    got = {r.brand: r for r in ingest.advance_watermark(state, rows, brands=["A"]).collect()}
    assert got["A"].watermark == dt.datetime(2024, 3, 1) and got["A"].backfill_complete
    assert (got["B"].backfill_offset, got["B"].backfill_complete, got["B"].last_run_at) == (500, False, dt.datetime(2024, 1, 1))
    early = {r.brand: r for r in ingest.advance_watermark(state, rows.select(F.lit("B").alias("_brand"), "updated_date"), end_of_feed=False).collect()}
    assert (early["B"].backfill_offset, early["B"].backfill_complete) == (500, False)


def test_landed_feed_prunes_by_day(spark, tmp_path):
    rows = [("A", "a@x.com", "2024-01-10 00:00:00"), ("A", "b@x.com", "2024-01-09 00:00:00"), ("A", "c@x.com", "2024-01-08 23:59:59"),
            ("A", "e@x.com", "bad"), ("B", "d@x.com", "2020-01-01 00:00:00"), ("B", "no-at", "2024-01-01 00:00:00")]
    feed = spark.createDataFrame(rows, "_brand string, email string, updated_date string")
    ingest.land_feed(feed, str(tmp_path / "feed"))
    out = ingest.landed_slice(spark.read.parquet(str(tmp_path / "feed")), {"A": dt.datetime(2024, 1, 10), "B": None})
    assert sorted(r.email for r in out.collect()) == ["a@x.com", "b@x.com", "d@x.com"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "updated_day" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_second_signup_batch_keeps_outcomes(spark):
    schema = "seq long, ts timestamp, email string, brand string, country string, site string, page string, first_name string, last_name string, reject_reason string"
    t = dt.datetime(2024, 1, 1)
    one = ingest.upsert_signups(spark.createDataFrame([(1, t, "a@x.com", "PICKL", "UAE", "pickl", "/", "Ann", None, None)], schema))
    log = spark.createDataFrame([("a@x.com", 1, "failed", "boom"), ("a@x.com", 2, "ok", "created")], "email string, attempt int, como_status string, como_detail string")
    stored = A.apply_signup_outcomes(one, log)
    assert stored.count() == 1
    two = spark.createDataFrame([(2, t, "a@x.com", "BONBIRD", "UAE", "bonbird", "/b", None, "Lee", None), (3, t, "b@x.com", "PICKL", "UAE", "pickl", "/", None, None, None)], schema)
    got = {r.email: r for r in ingest.upsert_signups(two, run_ts=dt.datetime(2025, 1, 1), existing=stored).collect()}
    a = got["a@x.com"]
    assert (a.como_status, a.como_detail, a.brand, a.site, a.first_name, a.last_name) == ("ok", "created", "PICKL", "pickl", "Ann", "Lee")
    assert got["b@x.com"].como_status is None and a.updated_at == dt.datetime(2025, 1, 1)


BODIES = ['{"status":"error","message":"retry at 12:30,then","n":1}', '{"a":[1,2,{"b":null}],"c":true}', '{"m":"café 日 \U0001d4b3"}', '{"q":"say \\"hi\\", ok: {x}"}',
          "[]", '{ "spaced" : [ 1 , 2 ] }', '{"p":"a\\\\"}', '{"u":"a\\/b"}']


def test_json_text_is_what_python_prints(spark):
    df = spark.createDataFrame(list(enumerate(BODIES)), "i int, body string")
    got = {r.i: r.t for r in df.select("i", A.py_json_text(F.col("body"), 500).alias("t")).collect()}
    assert [got[i] for i in range(len(BODIES))] == [json.dumps(json.loads(b)) for b in BODIES]


def test_tags_are_valid_json(spark):
    tags = [['A"B', "C\\D", "E\nF", "café"], [], None, ["X", "Y, Z"]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, tags array<string>")
    got = {r.i: (r.a, r.b) for r in df.select("i", A.tags_json(F.col("tags")).alias("a"), R.json_array_text("tags").alias("b")).collect()}
    for i, t in enumerate(tags):
        assert got[i][0] == json.dumps(t or []) and json.loads(got[i][1]) == (t or [])


def test_unicode_space(spark):
    raw = [" ann@x.com", "an n@x.com", " bob@x.com　", "\x1ceve@x.com", "ok@x.com"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, email string")
    got = {r.i: (r.email, r.email_ok) for r in E.with_email_check(df, "email").collect()}
    assert [got[i] for i in (0, 2, 3, 4)] == [("ann@x.com", True), ("bob@x.com", True), ("eve@x.com", True), ("ok@x.com", True)]
    assert got[1][1] is False


def test_hours_as_python_prints_them(spark):
    secs = [3600.0, 4140.0, 4500.0, 5220.5, 6300.0, 8100.0, 35640.0, 36000.5, 123456.5, 7380000.0, 9e6, 3780.0, 3959.9999]
    df = spark.createDataFrame([(s,) for s in secs + [3600.0 + 90 * k for k in range(400)]], "s double")
    assert all(r.t == f"{r.s / 3600:.1f}" for r in df.select("s", A.py_tenth(F.col("s") / 3600.0).alias("t")).collect())


def test_raised_calls_leave_their_text(spark):
    r = spark.createDataFrame([("a", "P", "create", '{"status":"error","errors":[{"code":"4001012"}]}', None, None, 'timed "out"'),
                               ("b", "P", "update", None, None, None, "refused")],
                              "email string, brand string, mode string, lookup_body string, create_body string, update_body string, error_text string")
    got = {x.email: x for x in A.push_outcomes(r).collect()}
    assert (got["a"].status, got["a"].detail) == ("failed", 'timed "out"') and got["b"].detail == "refused"


def test_repeated_attempts_keep_the_key(spark):
    out = A.record_push_state(fixture(spark, SMALL, "push_state"), A.push_outcomes(fixture(spark, SMALL, "push_responses")))
    assert out.groupBy("email", "brand").count().where("count > 1").isEmpty()


def test_capped_queue_is_sorted_without_a_brand_task(spark):
    m, st = pipeline.stored_master(spark, SMALL), fixture(spark, SMALL, "push_state")
    for limit in (100, 5000):
        q = A.pending_queue(m, st, limit=limit)
        assert "Window" not in q._jdf.queryExecution().executedPlan().toString()
        rows = [(r.brand, r.email) for r in q.collect()]
        assert all(sum(b == x for b, _ in rows) <= limit for x in C.BRANDS)
        for b in C.BRANDS:
            mine = [e for x, e in rows if x == b]
            assert mine == sorted(mine)


def test_preflight_totals_and_members(spark):
    schema = "email string, email_key string, duplicate_of string, needs_push boolean, tags array<string>"
    rows = [(f"a{i}@x.com", "k1" if i < 30 else f"k{i}", "z" if i == 40 else None, True, ["PICKL"] if i != 50 else ["WIFI"]) for i in range(60)]
    rows += [(f"b{i}@x.com", f"p{i // 2}", None, True, ["PICKL"]) for i in range(80)]
    m = spark.createDataFrame(rows, schema)
    st = spark.createDataFrame([(f"a{i}@x.com", "PICKL", "ok") for i in range(28)], "email string, brand string, status string")
    got = {r.check_no: r for r in R.preflight_summary(m, st).collect()}
    assert [(got[i]["count"], got[i].total) for i in (1, 2, 3, 4)] == [(25, 41), (25, 28), (1, 1), (1, 1)]
    assert not got[1].all_clear and got[1].queued == 139
    assert R.preflight_collision_members(m).count() == 30 + 80
    assert R.preflight_inbox_collisions(m).count() == 25 and R.preflight_leaked_duplicates(m).collect()[0].duplicate_of == "z"


def test_dimension_tables_are_parameters(spark):
    spec = C.SourceSpec(source_table="s", email_expr="email", source_tag="S", key_expr="email", extra_tags_expr="parse_market(market)")
    df = spark.createDataFrame([("a@wrong.tld", "pickl-atlantis-hall"), ("b@spam.com", None)], "email string, market string")
    dims = C.Dimensions.from_tables(corrections=spark.createDataFrame([("wrong.tld", "right.com")], "wrong string, correct string"),
                                    blocked=spark.createDataFrame([("spam.com",)], "domain string"),
                                    countries=spark.createDataFrame([("atlantis", "ATL")], "slug string, tag string"))
    got = M.merge_sources({"s": df}, registry=[spec], dims=dims).master.collect()
    assert [(r.email, r.tags) for r in got] == [("a@right.com", ["S", "PICKL", "ATL", "HALL"])]
    with pytest.raises(ValueError):
        C.Dimensions.from_tables(blocked=spark.range(50).select(F.col("id").cast("string").alias("domain")), most=10)


def test_stream_table_compacts(spark, tmp_path):
    events = fixture(spark, SMALL, "signup_events")
    src, table = str(tmp_path / "src"), str(tmp_path / "table")
    events.repartition(3, "event_id").write.parquet(src)
    S.start_signup_stream(spark, src, table, str(tmp_path / "chk"), events.schema, files_per_trigger=1).awaitTermination()
    before = sorted(map(str, S.read_signup_table(spark, table).collect()))
    S.compact_signup_table(spark, table)
    assert any(f.startswith("base=") for f in os.listdir(table))
    assert sorted(map(str, S.read_signup_table(spark, table).collect())) == before
    assert len(epochs.marked(spark, table, "epoch")) == 3
