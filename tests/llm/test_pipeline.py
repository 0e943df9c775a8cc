"""The five stages, each held against a plain version on its own input."""

import sys

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import edge_docs  # noqa: E402
from test_native_ops import plain_hits  # noqa: E402
from test_python_ops import plain_links  # noqa: E402

import corpus_pipeline  # noqa: E402
from custfold.llm.common import store, table  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, SF), "t")
        got = {r["doc_id"] for r in out.collect()}
        if name == "toxicity":
            gone = set(rows) - got
            assert sum(toxic.get(i) == 0 for i in gone) <= 0.02 * len(rows)
            assert sum(toxic.get(i) == 1 for i in gone) >= 0.8 * sum(t == 1 for t in toxic.values())
        elif name == "exact_dedup":
            last = {r["text"]: i for i, r in sorted(rows.items())}
            assert got == set(last.values())
        elif name == "near_dedup":
            assert got == {c for c, _ in plain_links([(i, r["text"]) for i, r in rows.items()]).values()}
        elif name == "decontaminate":
            assert got == {i for i, r in rows.items() if not plain_hits(r["text"], bench)[1]}
        else:
            mixed = out.collect()
            assert got <= set(rows) and all(1 <= r["copies"] <= 3 for r in mixed)
            continue
        assert out.columns == columns
        docs, rows = out, {i: r for i, r in rows.items() if i in got}


def test_stages_on_odd_rows(spark):
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, "/root/testdata/sf0.001"), "t")
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
        if name != "mix":
            assert out.columns == docs.columns
            docs = out


def test_run_leaves_only_what_its_result_reads(spark):
    import os

    from custfold.llm.common import stored_paths
    before = list(stored_paths(spark))
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [p for p in stored_paths(spark) if p not in before]
    names = [p.rsplit("/", 1)[1] for p in left]
    assert out.count() > 0 and [n for n in names if n.startswith("stage-")] == [n for n in names if n.startswith("stage-decontaminate")]
    assert all(os.path.isdir(p) for p in left) and not any(n.startswith(("join-", "bench-", "dedup-")) for n in names)


def test_texts_without_a_match_are_not_shuffled(spark):
    """A join by document key moves the texts that match, and few others."""
    from pyspark.sql import functions as F

    from custfold.llm.common import doc_hash, sift, without
    docs = spark.range(20000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 5000).alias("text"),
                                     F.lit(1).alias("_h"), F.lit(2).alias("_slot"))
    docs = store(docs.withColumn("text", F.when(F.col("text") != "t9", F.col("text"))), "t")
    gone = store(docs.where("doc_id % 13 = 0 or doc_id is null and text > 't4'")
                 .select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h")).distinct(), "t")
    keys = {tuple(r) for r in gone.collect()}
    hashed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h")).collect()
    want = sorted((str(r.doc_id), str(r.text)) for r in hashed if (r.doc_id, r._h) not in keys)
    out = without(docs, gone)
    assert out.columns == docs.columns and sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == want
    text = F.coalesce(docs["text"], F.lit(""))
    some, rest = sift(docs, doc_hash(docs["doc_id"], F.xxhash64(text)), gone, doc_hash("doc_id", "_h"))
    matches = len(hashed) - len(want)
    assert some.count() + rest.count() == len(hashed) and matches <= some.count() <= matches + 0.15 * len(want)
    empty = gone.limit(0)
    assert without(docs, empty).count() == len(hashed) and without(docs.limit(0), gone).count() == 0
