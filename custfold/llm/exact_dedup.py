"""Exact dedup over counting quotient filters.

1. Every partition puts the 64-bit fingerprints of its texts into a counting
   quotient filter: the high 32 bits are the quotient, the low 32 bits the
   remainder kept in the quotient's sorted run, with a counter each.
2. The filters are cut into shards of quotients and merged shard by shard:
   the sorted remainders of equal quotients are merged and their counters
   added.  Quotient and remainder together are the whole fingerprint, so a
   merge loses nothing.
3. Texts whose fingerprint counts more than one go to byte verification: they
   are grouped by the text itself (one copy per map task is shuffled, since
   the grouping combines before the shuffle).

Defined cases: a null text counts as empty; equal empty texts are copies; a
null ``doc_id`` is smaller than any other; of rows with equal text and equal
``doc_id`` exactly one is kept; a very long text is hashed whole
where it is read and moves only if its fingerprint repeats; an empty table gives an
empty result.  Other columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import doc_hash, ship, sift, store, table, text_of

#: Fingerprints that a shard of merged filters holds on average.
SHARD_ROWS = 1 << 20
MIN_SHARD_BITS = 6
_FILTER = "shard int, quotients binary, runs binary, remainders binary, counts binary"


def build_filter(fingerprints: np.ndarray, shard_bits: int) -> Iterator[tuple]:
    """The counting quotient filter of one partition, cut into shards:
    ``(shard, occupied quotients, run lengths, remainders, counts)``."""
    keys, counts = np.unique(fingerprints.astype(np.uint64), return_counts=True)
    quotient = (keys >> np.uint64(32)).astype(np.uint32)
    remainder = keys.astype(np.uint32)
    shard = quotient >> np.uint32(32 - shard_bits)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
        if hi > lo:
            occupied, runs = np.unique(quotient[lo:hi], return_counts=True)
            yield int(shard[lo]), occupied, runs.astype(np.uint32), remainder[lo:hi], counts[lo:hi].astype(np.uint32)


def merge_filters(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Merge filters of one shard: fingerprints in order and their counts."""
    keys = np.concatenate([(np.repeat(q, r).astype(np.uint64) << np.uint64(32)) | m.astype(np.uint64)
                           for q, r, m, _ in parts])
    counts = np.concatenate([c.astype(np.int64) for *_, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def repeated_fingerprints(prints: DataFrame, col: str = "fp") -> DataFrame:
    """Fingerprints (``fp``, ``copies``) that occur more than once."""
    ship(prints.sparkSession)
    n = prints.count()
    bits = max(MIN_SHARD_BITS, min(24, (n // SHARD_ROWS).bit_length()))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [b["fp"].to_numpy().view(np.uint64) for b in batches]
        if not seen:
            return
        rows = [(s, q.tobytes(), r.tobytes(), m.tobytes(), c.tobytes())
                for s, q, r, m, c in build_filter(np.concatenate(seen), bits)]
        yield pd.DataFrame(rows, columns=["shard", "quotients", "runs", "remainders", "counts"])

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        parts = [tuple(np.frombuffer(x, np.uint32) for x in row)
                 for row in g[["quotients", "runs", "remainders", "counts"]].itertuples(index=False)]
        keys, counts = merge_filters(parts)
        more = counts > 1
        return pd.DataFrame({"fp": keys[more].view(np.int64), "copies": counts[more]})

    return (prints.select(F.col(col).alias("fp")).mapInPandas(build, _FILTER)
            .groupBy("shard").applyInPandas(merge, "fp long, copies long"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     normalise=lambda c: c) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``.  Of equal (normalised) texts the row with the largest
    ``doc_id`` stays."""
    text: Column = normalise(text_of(docs, text_col))
    ids = store(docs.select(docs[id_col].alias("doc_id"), F.xxhash64(text).alias("fp"),
                            F.sha2(text, 256).alias("text_sha256"),
                            F.monotonically_increasing_id().alias("_row")), "dedup-ids")
    repeated = store(repeated_fingerprints(ids), "dedup-repeated")

    # Byte verification of the routed texts: grouped by the bytes themselves.
    bodies = docs.select(docs[id_col].alias("doc_id"), text.alias("body"), F.xxhash64(text).alias("fp"))
    routed = sift(bodies, bodies["fp"], repeated, F.col("fp"))[0].join(repeated.select("fp"), "fp")
    groups = (routed.groupBy("body").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
              .where("group_size > 1")
              .select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size"))
    groups = store(groups, "dedup-groups")
    # Rows that repeat the kept doc_id: the first of them stays.
    stays = (ids.join(groups, "text_sha256").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy("text_sha256").agg(F.min("_row").alias("_keep_row")))
    groups = store(groups.join(stays, "text_sha256"), "dedup-keepers")
    alone = F.col("group_size").isNull()
    return (ids.join(groups, "text_sha256", "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"), "text_sha256"))


def unique_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, columns unchanged.
    Of rows that agree in ``doc_id`` and text any one stays."""
    out = store(exact_duplicates(docs, id_col, text_col).where(~F.col("kept"))
                .select("doc_id", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("tie"), "text_sha256"), "dedup-dropped")
    sha = F.sha2(text_of(docs, text_col), 256)

    some, rest = sift(docs, doc_hash(docs[id_col], sha), out, doc_hash("doc_id", "text_sha256"))

    def matching(rows: DataFrame, kind: str) -> DataFrame:
        named = rows.select(F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_sha"))
        return some.join(named, docs[id_col].eqNullSafe(named["_gone_id"]) & (sha == named["_gone_sha"]), kind)

    stay = rest.union(matching(out, "left_anti"))
    ties = out.where("tie")
    return stay if ties.isEmpty() else stay.union(matching(ties, "left_semi").dropDuplicates([id_col, text_col]))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies over all of ``documents``, byte for byte."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
