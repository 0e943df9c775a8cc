"""Line dedup by overlapping three-line windows (DataFrame functions only).

Every run of ``WINDOW`` consecutive lines is hashed (128 bits) and counted
over all documents.  The first occurrence of a repeated window, in order of
``doc_id`` (nulls last) and position, stays; the positions that any later
occurrence covers are merged per document and those lines removed.

Counting combines before the shuffle and the later steps touch repeated
windows only, so a window that a third of all documents share is a third of
the rows of joins that adaptive execution splits, never one task's group.

Defined cases: a null text counts as empty (one empty line); a document of
fewer lines than a window loses nothing; rows with equal ``doc_id`` and text
are one document and give equal rows; a very long text has all its
windows taken and is put together in one task; an empty table gives an empty result;
no other column of the input is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from custfold.llm.common import same_key, store, table, text_of

WINDOW = 3


def _windows(rows: DataFrame, lines: Column, window: int) -> DataFrame:
    """``a, b`` (hash) of every window with its place ``at = (late, doc_id,
    _h, pos)``, whose order is the order of occurrence."""
    def one(i: Column) -> Column:
        parts = [F.get(lines, i + k) for k in range(window)]
        return F.struct(i.alias("pos"), F.xxhash64(*parts).alias("a"),
                        F.xxhash64(F.lit(1), *reversed(parts)).alias("b"))

    n = F.size(lines)
    found = F.when(n >= window, F.transform(F.sequence(F.lit(0), n - window), one))
    return (rows.select("doc_id", "_h", F.explode(found).alias("w"))
            .select("w.a", "w.b", F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_h", F.col("w.pos").alias("pos")).alias("at")))


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` (what stays) of every row."""
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("doc_id"), text.alias("body"), F.xxhash64(text).alias("_h"))
    lines = F.split("body", "\n", -1)
    windows = _windows(rows.withColumn("_lines", lines), F.col("_lines"), window)

    repeated = store(windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b"), "line-repeats")
    places = store(windows.join(repeated, ["a", "b"]), "line-places")
    first = places.groupBy("a", "b").agg(F.min("at").alias("first"))
    later = places.join(first, ["a", "b"]).where(F.col("at") > F.col("first"))
    gone = (later.select("at.doc_id", "at._h", F.explode(F.sequence("at.pos", F.col("at.pos") + (window - 1))).alias("pos"))
            .groupBy("doc_id", "_h").agg(F.collect_set("pos").alias("gone")))

    joined = rows.join(gone.hint("shuffle_hash"), same_key(rows, gone, ["doc_id", "_h"]), "left").select(
        rows["doc_id"], "body", "gone")

    def kept(ls: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone"))
        return F.concat_ws("\n", F.transform(stay, lambda i: F.get(ls, i)))

    n_lines = F.length("body") - F.length(F.translate("body", "\n", "")) + 1
    return joined.select(
        "doc_id", n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.array_size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("body"))
        .otherwise(F.get(F.transform(F.array(lines), kept), F.lit(0))).alias("text"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated three-line windows over all of ``documents``."""
    out = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


OP5_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM d),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY l[i], l[i + 1], l[i + 2] ORDER BY doc_id, i) AS rn FROM w),
p AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM f WHERE rn > 1),
u AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM d),
k AS (SELECT u.doc_id, count(*) AS n_lines, count(p.pos) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY u.pos) FILTER (WHERE p.pos IS NULL), '') AS kept
      FROM u LEFT JOIN p ON u.doc_id = p.doc_id AND u.pos = p.pos GROUP BY u.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(kept) AS text_sha256 FROM k
"""
