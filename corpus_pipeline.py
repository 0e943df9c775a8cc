"""Corpus pipeline: stages over ``documents``, each on what the one before kept.

1. ``toxicity`` drops the documents that the fitted machine scores toxic.
2. ``exact_dedup`` keeps the row with the largest ``doc_id`` of equal texts.
3. ``near_dedup`` keeps the first document of each class of linked texts.
4. ``decontaminate`` drops documents that hold a benchmark window.
5. ``mix`` draws the training mix: how often each remaining document is taken.

Each stage is a function of ``(spark, docs, sf_dir)``; all but the last return
the columns of ``documents``.  Null, empty and repeated rows are treated as the
stages' operators define it; very long texts are rows like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm import decontaminate, exact_dedup, jaccard_join, source_mix
from custfold.llm import toxicity as tox
from custfold.llm.common import release, store, stored_paths, table, without


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tox.without_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.unique_texts(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_texts(docs)
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("_h") == F.col("class_h"))
    return without(docs, store(found.where(~first).select("doc_id", "_h"), "near-dropped"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination_digest(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")))
    return without(docs, store(found.where("contaminated").select("doc_id", "_h"), "bench-dropped"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with the number of copies."""
    return source_mix.mix_sources(docs).where("copies > 0")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", decontamination), ("mix", mix)]
ORACLE_SQL = None  # no stage but the second and fourth can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.
    What a stage and the one before it stored on the way is deleted then."""
    docs = table(spark, sf_dir, "documents")
    last: list[str] = []
    for i, (name, stage) in enumerate(STAGES):
        before = len(stored_paths(spark))
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage-{name}")
            *made, out = stored_paths(spark)[before:]
            release(spark, last + made)
            last = [out]
    return docs
