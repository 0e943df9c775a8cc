"""Properties: fold == sequential merge, idempotent refresh, duplicate and
queue invariants, source order irrelevant."""

import random

from pyspark.sql import functions as F

from custfold.config import SourceSpec
from custfold.operators import master as M
from custfold.plans import pipeline, reports as R

from conftest import SMALL

SPECS = [SourceSpec(source_table=name, email_expr="email", first_name_expr="fn", last_name_expr="ln",
                    source_tag=tag, extra_tags_expr="tags", allow_email_expr="ae", priority=prio, key_expr="pk")
         for name, tag, prio in [("src_a", "A", 1), ("src_c", "C", 2), ("src_b", "B", 2)]]


def _clean_tags(tags):
    out = []
    for t in tags:
        if t is None or t.strip(" ") == "":
            continue
        u = t.strip(" ").upper()
        if u not in out:
            out.append(u)
    return out or None


def _model(sources, prior):
    """Source-by-source upsert with 'fill NULLs, union tags/sources, touch
    only on gain', the way the rule is written."""
    state = {e: dict(r) for e, r in (prior or {}).items()}
    counts = {}
    for spec in sorted(SPECS, key=lambda s: (s.priority, s.source_table)):
        rows = {}
        for r in sorted(sources[spec.source_table], key=lambda r: r["pk"]):
            rows.setdefault(r["email"], r)
        n = 0
        for email, r in rows.items():
            new = {"first_name": r["fn"], "last_name": r["ln"], "allow_email": r["ae"],
                   "tags": _clean_tags([spec.source_tag] + list(r["tags"] or [])), "sources": [spec.source_table]}
            old = state.get(email)
            if old is None:
                state[email] = dict(new, needs_push=True)
                n += 1
                continue
            gain = any(old[f] is None and new[f] is not None for f in ["first_name", "last_name", "allow_email"])
            gain = gain or not set(new["tags"]) <= set(old["tags"] or []) or \
                not set(new["sources"]) <= set(old["sources"] or [])
            if gain:
                for f in ["first_name", "last_name", "allow_email"]:
                    old[f] = old[f] if old[f] is not None else new[f]
                old["tags"] = _clean_tags((old["tags"] or []) + new["tags"])
                old["sources"] = sorted(set((old["sources"] or []) + new["sources"]))
                old["needs_push"] = True
                n += 1
        counts[spec.source_table] = n
    return state, counts


def _random_case(rng):
    emails = [f"e{i}@x.com" for i in range(6)]
    sources, pk = {}, 0
    for spec in SPECS:
        rows = []
        for _ in range(rng.randint(0, 8)):
            pk += 1
            rows.append({"email": rng.choice(emails), "pk": f"{pk:04d}", "fn": rng.choice([None, "Ann", "Bob"]),
                         "ln": rng.choice([None, "Lee"]), "ae": rng.choice([None, True, False]),
                         "tags": rng.choice([None, [], ["p"], [" Q ", "P"], ["R"]])})
        sources[spec.source_table] = rows
    prior = {}
    for e in rng.sample(emails, rng.randint(0, 3)):
        prior[e] = {"first_name": rng.choice([None, "Cy"]), "last_name": None, "allow_email": rng.choice([None, True]),
                    "tags": rng.choice([["A"], ["P", "A"], ["Z"]]), "sources": rng.choice([["src_a"], ["old"]]),
                    "needs_push": rng.choice([True, False])}
    return sources, prior


def _frames(spark, sources, prior):
    schema = "email string, pk string, fn string, ln string, ae boolean, tags array<string>"
    dfs = {k: spark.createDataFrame([(r["email"], r["pk"], r["fn"], r["ln"], r["ae"], r["tags"]) for r in v], schema)
           for k, v in sources.items()}
    pschema = ("email string, first_name string, last_name string, nationality string, birthday date, "
               "tags array<string>, allow_email boolean, sources array<string>, needs_push boolean")
    pdf = spark.createDataFrame([(e, r["first_name"], r["last_name"], None, None, r["tags"], r["allow_email"],
                                  r["sources"], r["needs_push"]) for e, r in prior.items()], pschema)
    return dfs, pdf


def test_fold_equals_sequential_merge(spark):
    rng = random.Random(7)
    for case in range(12):
        sources, prior = _random_case(rng)
        use_prior = case % 2 == 0
        dfs, pdf = _frames(spark, sources, prior)
        res = M.merge_sources(dfs, registry=SPECS, prior=pdf if use_prior else None)
        want, want_counts = _model(sources, prior if use_prior else None)
        got = {r.email: r for r in res.master.collect()}
        assert set(got) == set(want), case
        for e, w in want.items():
            g = got[e]
            assert (g.first_name, g.last_name, g.allow_email) == (w["first_name"], w["last_name"], w["allow_email"])
            assert (g.tags or None) == w["tags"], (case, e)
            assert sorted(g.sources) == sorted(w["sources"]), (case, e)
            assert g.needs_push == w["needs_push"], (case, e)
        counts = {r.source: r.rows_merged for r in M.refresh_counts(res).collect()}
        assert counts == want_counts, case


def test_source_order_irrelevant(spark):
    rng = random.Random(3)
    sources, _ = _random_case(rng)
    dfs, _ = _frames(spark, sources, {})
    a = M.merge_sources(dfs, registry=SPECS).master
    shuffled = {k: v.orderBy(F.rand(5)) for k, v in dfs.items()}
    b = M.merge_sources(shuffled, registry=list(reversed(SPECS))).master
    cols = ["email", "first_name", "last_name", "allow_email", F.array_join("tags", ",").alias("t")]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())


def test_refresh_is_idempotent(spark):
    srcs = pipeline.source_tables(spark, SMALL)
    first = M.rebuild_pipeline(srcs).master.checkpoint()
    again = M.merge_sources(srcs, prior=first)
    assert again.master.where(F.col("_changed")).count() == 0
    counts = {r.source: r.rows_merged for r in M.refresh_counts(again).collect()}
    assert set(counts.values()) == {0}


def test_duplicate_and_queue_invariants(spark):
    m = pipeline.master_table(spark, SMALL)
    per_key = m.where(F.col("email_key").isNotNull()).groupBy("email_key") \
        .agg(F.count_if(F.col("duplicate_of").isNull()).alias("keepers"))
    assert per_key.where(F.col("keepers") != 1).count() == 0
    assert m.where(F.col("needs_push") & F.col("duplicate_of").isNotNull()).count() == 0
    checks = {r.check_no: r for r in R.preflight_summary(m, pipeline.push_state(spark, SMALL)).collect()}
    assert checks[1]["pass"] and checks[3]["pass"]
