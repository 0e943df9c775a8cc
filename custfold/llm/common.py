"""Helpers shared by the corpus operators.

Row identity used by every operator of this subpackage: rows with equal
``doc_id`` and equal text are one document.  ``doc_key`` names that identity
as ``(doc_id, _h)`` with ``_h = xxhash64(text)``; joins on it are null-safe,
so a null ``doc_id`` is a value like any other.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the corpus operators: runs of ASCII digits and letters and of
#: anything outside ASCII (before A-Z are lower-cased).  It names what a word has:
#: Java matches the same class written as what it has not many times slower.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: Bits of a filter for each of its keys (about one other row in 16 passes), for
#: all of them at most, and in one row of it.
KEY_BITS, MOST_BITS, SLICE = 16, 1 << 27, 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that the
    functions of Python operators can be loaded wherever a task runs."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._llm_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local master may go without the setting; it then gets one scratch
    folder per application.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not hasattr(sc, "_llm_scratch"):
        sc._llm_scratch = tempfile.mkdtemp(prefix="llm-scratch-")
    return sc._llm_scratch


def store(df: DataFrame, label: str, key: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that survive lost executors, and gives the
    planner the measured size, so a broadcast is its own choice by bytes.
    With ``key`` the rows lie in buckets by that column, as many as a shuffle
    has partitions, so a join by it shuffles the other side only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    if key is None:
        df.write.parquet(path)
        stored_paths(spark).append(path)
        return spark.read.schema(df.schema).parquet(path)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(name, format="parquet")
    stored_paths(spark).append(path)
    out = spark.table(name)
    out.schema  # resolved, so the name can go; an external table's files stay
    spark.sql(f"DROP TABLE {name}")
    return out


def stored_paths(spark: SparkSession) -> list[str]:
    """The tables that ``store`` wrote in this application, in order."""
    sc = spark.sparkContext
    if not hasattr(sc, "_llm_paths"):
        sc._llm_paths = []
    return sc._llm_paths


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that no result reads any more."""
    held, jvm = stored_paths(spark), spark._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        held.remove(p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, col: str = "text") -> Column:
    """The text column with null counted as empty."""
    return F.coalesce(df[col].cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def same_key(a: DataFrame, b: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of the key columns of two DataFrames."""
    cond = a[names[0]].eqNullSafe(b[names[0]])
    for n in names[1:]:
        cond = cond & a[n].eqNullSafe(b[n])
    return cond


def key_filter(keys: DataFrame, key: Column) -> tuple[DataFrame, int]:
    """``_slot, _bits``: a bitmap of the hash ``key`` of every row of ``keys``,
    and the number of its bits (bounded, so it can be broadcast at any size)."""
    bits = min(MOST_BITS, max(SLICE, 1 << (keys.count() * KEY_BITS).bit_length()))
    at = keys.select(F.pmod(key, F.lit(bits)).alias("at"))
    return at.groupBy(F.expr(f"at div {SLICE}").alias("_slot")).agg(F.bitmap_construct_agg(F.col("at") % SLICE).alias("_bits")), bits


def sift(rows: DataFrame, key: Column, keys: DataFrame, their_key: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose hash ``key`` may be one of ``keys``, and
    those where it is none.  Only the first part, all matches and a few more, need
    be shuffled for a join, so long texts that match nothing stay where they are."""
    held, bits = key_filter(keys, their_key)
    held = F.broadcast(store(held, "key-filter"))
    at = F.pmod(key, F.lit(bits))
    place = (at % SLICE).cast("int")
    byte = F.conv(F.hex(F.substring(held["_bits"], F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = (F.floor(at / SLICE) == held["_slot"]) & (F.getbit(byte, place % 8) == 1)
    return rows.join(held, there, "left_semi"), rows.join(held, there, "left_anti")


def doc_hash(id_: Column | str, text_hash: Column | str) -> Column:
    """The hash of a document's key for ``sift``."""
    return F.xxhash64(id_, text_hash)


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose document is not in ``gone (doc_id, _h)``, which is
    read several times; the columns of ``docs`` stay as they are, whatever their names."""
    named = gone.select(F.col("doc_id").alias("_gone_id"), F.col("_h").alias("_gone_h"))
    h = F.xxhash64(text_of(docs, text_col))
    some, rest = sift(docs, doc_hash(docs[id_col], h), gone, doc_hash("doc_id", "_h"))
    return rest.union(some.join(named, docs[id_col].eqNullSafe(named["_gone_id"]) & (h == named["_gone_h"]), "left_anti"))
