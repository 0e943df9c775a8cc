"""Rules mended in the third round: sources stored when asked for and spread over
tasks, landed pages in several files, cheaper address checks."""

import glob
import os

from pyspark.sql import functions as F

from custfold import config as C
from custfold import session
from custfold.functions import email as E
from custfold.operators import ingest
from custfold.plans import pipeline, queries_activate
from custfold.streaming.pos_sync import run_interrupted_sync


def tables(spark, path):
    """A folder with the tables that the sources read."""
    def put(name, df):
        df.coalesce(1).write.parquet(f"{path}/{name}.parquet")

    put("customer", spark.range(40).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey"))
    put("orders", spark.range(40).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "'5-LOW' AS o_orderpriority", "DATE '2024-01-01' AS o_orderdate"))
    put("events", spark.range(40).selectExpr("id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id % 9 AS user_id", "'signup' AS event_type"))
    return str(path)


def test_a_lookup_stores_only_the_source_it_reads(spark, tmp_path):
    sf = tables(spark, tmp_path)
    assert queries_activate.q_lookup_wifi(spark, sf).count() >= 1
    assert {k[3] for k in pipeline._STORED if k[1] == sf} == {"wifi_guests"}


def test_a_feed_in_one_file_is_stored_in_many(spark, tmp_path):
    sf = tables(spark, tmp_path)
    wifi = pipeline.stored_sources(spark, sf)["wifi_guests"]
    assert len(wifi.inputFiles()) > 1
    assert sorted(map(tuple, wifi.collect())) == sorted(map(tuple, pipeline.source_tables(spark, sf)["wifi_guests"].collect()))


def test_pages_land_in_several_files(spark):
    root = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/pos-sync-*"))
    feed = spark.range(60).selectExpr("id AS _seq", "concat('/c/', id % 9) AS resource_uri", "'A' AS _brand", "'Ana' AS first_name", "'K' AS last_name",
                                      "concat('u', id, '@x.com') AS email", "true AS email_opt_in", "'2024-01-02 00:00:00' AS updated_date")
    rows, half, last = run_interrupted_sync(spark, feed)
    (made,) = set(glob.glob(f"{root}/pos-sync-*")) - before
    assert len(glob.glob(os.path.join(made, "landed", "*.parquet"))) > 6
    want = ingest.revel_customers(feed)
    assert sorted(map(tuple, rows.select(*ingest.POS_COLUMNS).collect())) == sorted(map(tuple, want.select(*ingest.POS_COLUMNS).collect()))
    assert [(r.backfill_offset, r.backfill_complete) for r in half.collect()] == [(30, False)]
    assert [(r.backfill_offset, r.backfill_complete) for r in last.collect()] == [(0, True)]


def test_strip_takes_every_python_space_without_a_pattern(spark):
    texts = [f"{a}x {a} y{a}{a}" for a in map(chr, range(0x3100)) if not 0xd800 <= ord(a) < 0xe000] + ["", " \t　", None, "​x﻿"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", E.py_strip("t").alias("s"))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.s == (None if r.t is None else r.t.strip()) for r in df.collect())


def test_listed_domains_are_found_as_the_check_finds_them(spark):
    d = C.DISCARD_REASONS
    domains = [*C.INTERNAL_DOMAINS, *C.DISPOSABLE_DOMAINS, "x.com"]
    texts = [f for x in domains for f in (f"a@{x}", f" A@{x.upper()} ", f"a@b@{x}", f"@{x}", f"a b@{x}", x, f"a@{x}x", f"a@{x}\n.")] + ["", None, *C.PLACEHOLDER_ADDRESSES]
    df = spark.createDataFrame([(t, t) for t in texts], "raw string, email string")
    got = E.with_email_check(df).select("raw", E.has_reason("raw", d).alias("hit"), F.coalesce(E.reason_class("email_reason").isin(list(d)), F.lit(False)).alias("want"))
    assert [r.raw for r in got.collect() if r.hit != r.want] == []
    assert got.where("hit").count() > 0


def test_short_or_rejected_words_try_no_pattern(spark, monkeypatch):
    mask = E._consonant_mask
    tried = lambda w: F.when((F.length(w) < 6) | (w == "discardedword"), F.raise_error("tried").cast("string")).otherwise(mask(w))
    monkeypatch.setattr(E, "_consonant_mask", tried)
    texts = ["discardedword@grubtech.com", "aaa@x.com", "aaaaa@x.com", "aaaaaa@x.com", "sdfgsdfgsdfg@x.com", "sdfgsdfgsdfg@grubtech.com", "sdfgsdfgsdfg", "abc.sdfgsdfg@x.com", "", None, "hjklhjkl12@x.com"]
    df = spark.createDataFrame([(t, t) for t in texts], "raw string, email string")
    staged = E.with_email_check(df).select("raw", "email", "email_ok", "email_reason")
    got = staged.collect()
    monkeypatch.undo()
    whole = df.select("raw", E.classify_email("raw").alias("c")).select("raw", "c.*")
    assert got == whole.collect()
    signals = df.select("raw", F.substring_index("raw", "@", 1).alias("l")).where("l IS NOT NULL")
    both = E.with_gibberish(signals, "l").select("gibberish_signals", E.gibberish_signals("l").alias("w")).collect()
    assert all(r.gibberish_signals == r.w for r in both)
