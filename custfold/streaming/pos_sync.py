"""High-water-mark load of the point-of-sale feed as a stream.

Pages of the feed land as files; every record carries its brand and the
brand's record count (``_total``) as the source reported it.  Each epoch writes
the page rows (classified, rejects dropped) and the new state of the brands,
then one mark that commits both.  So

* rows and state never disagree: readers take committed epochs only;
* a replayed epoch overwrites its own folders and starts from the state of the
  epoch before it, so nothing is counted twice;
* an interrupted backfill goes on from ``backfill_offset``; when as many records
  came in as the source has, the backfill is complete and the offset is 0.

The state holds one row per brand.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custfold import config as C
from custfold.functions.common import ts_ntz
from custfold.functions.email import has_reason
from custfold.operators import ingest
from custfold.session import ensure_checkpoint_dir
from custfold.streaming import epochs

EPOCH = "epoch"


def next_state(state: DataFrame | None, page: DataFrame, run_ts: _dt.datetime = C.RUN_TS) -> DataFrame:
    """Brand states after the records of ``page``: the offset grows with the
    records fetched, the mark to the newest date, until all are there."""
    stamp = F.expr("try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ)")
    got = page.groupBy(F.col("_brand").alias("_b")).agg(F.count(F.lit(1)).alias("_n"), F.max(stamp).alias("_newest"), F.max("_total").alias("_all"))
    if state is None:
        state = page.sparkSession.createDataFrame([], ingest.SYNC_STATE_SCHEMA)
    both = state.join(got, F.col("brand") == F.col("_b"), "full")
    before = F.coalesce("backfill_complete", F.lit(False))
    offset = F.coalesce("backfill_offset", F.lit(0)) + F.coalesce("_n", F.lit(0))
    done = before | F.coalesce(offset >= F.col("_all"), F.lit(False))
    return both.select(F.coalesce("brand", "_b").alias("brand"),
                       F.when(done, F.lit(0)).otherwise(offset).cast("long").alias("backfill_offset"),
                       done.alias("backfill_complete"), F.greatest("watermark", "_newest").alias("watermark"),
                       F.when(F.col("_b").isNotNull(), ts_ntz(run_ts)).otherwise(F.col("last_run_at")).alias("last_run_at"))


def _path(table_dir: str, kind: str, epoch: int) -> str:
    return f"{table_dir.rstrip('/')}/{kind}/{EPOCH}={epoch:09d}"


def sync_epoch(table_dir: str, run_ts: _dt.datetime = C.RUN_TS, before_commit: Callable[[int], None] | None = None):
    """The ``foreachBatch`` function of the load."""
    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if epoch in epochs.marked(spark, table_dir, EPOCH):
            return
        typed = ingest.pos_rows(batch)
        hit = has_reason("email", C.DISCARD_REASONS)
        rows = ingest.classified_pos_rows(typed.where(~hit))
        rows.write.mode("overwrite").parquet(_path(table_dir, "rows", epoch))
        prior = [e for e in epochs.marked(spark, table_dir, EPOCH) if e < epoch]
        state = spark.read.parquet(_path(table_dir, "state", prior[-1])) if prior else None
        next_state(state, batch, run_ts).coalesce(1).write.mode("overwrite").parquet(_path(table_dir, "state", epoch))
        if before_commit:
            before_commit(epoch)
        epochs.mark(spark, table_dir, EPOCH, epoch)
    return run


def start_pos_sync(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str, schema,
                   files_per_trigger: int = 100, **options) -> StreamingQuery:
    """Load what has landed and stop."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    return (stream.writeStream.foreachBatch(sync_epoch(table_dir, **options))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_pos_table(spark: SparkSession, table_dir: str, run_ts: _dt.datetime = C.RUN_TS) -> DataFrame:
    """The stored customers: the newest arrival per key over committed epochs."""
    done = epochs.marked(spark, table_dir, EPOCH)
    rows = spark.read.parquet(*[_path(table_dir, "rows", e) for e in done])
    return ingest.upsert_pos_customers(None, rows, run_ts)


def read_sync_state(spark: SparkSession, table_dir: str) -> DataFrame:
    return spark.read.parquet(_path(table_dir, "state", epochs.marked(spark, table_dir, EPOCH)[-1]))


class Interrupted(RuntimeError):
    """Raised by a run that is cut off before it commits."""


def run_interrupted_sync(spark: SparkSession, feed: DataFrame, pages: int = 6) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A backfill that is cut off: half of the pages land (each in several files,
    so that a large feed is not written by one task a page), the first run dies
    after writing rows and state of its epoch but before the commit, the second
    run replays that epoch, the other pages land and a third run ends the
    backfill.  Returns the customers, the state after the replay and the last
    state."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pos-sync-{uuid.uuid4().hex}"
    total = feed.groupBy(F.col("_brand").alias("_b")).agg(F.count(F.lit(1)).alias("_total"))
    page = feed.join(total, F.col("_brand") == F.col("_b")).drop("_b").withColumn("_page", F.pmod("_seq", F.lit(pages)))
    src, table, chk = f"{root}/landed", f"{root}/table", f"{root}/chk"
    half, files = pages // 2, max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")) // pages)
    part = F.pmod(F.xxhash64("_seq"), F.lit(files))
    page.where(F.col("_page") < half).repartition(half * files, "_page", part).write.parquet(src)
    schema = spark.read.parquet(src).schema

    def die(epoch: int) -> None:
        raise Interrupted(f"cut off in epoch {epoch}")

    query = start_pos_sync(spark, src, table, chk, schema, half * files, before_commit=die)
    try:
        query.awaitTermination()
    except Exception as e:
        if "cut off in epoch" not in str(e):
            raise
    start_pos_sync(spark, src, table, chk, schema, half * files).awaitTermination()
    halfway = epochs.marked(spark, table, EPOCH)[-1]
    page.where(F.col("_page") >= half).repartition((pages - half) * files, "_page", part).write.mode("append").parquet(src)
    start_pos_sync(spark, src, table, chk, schema, files_per_trigger=2 * files).awaitTermination()
    return read_pos_table(spark, table), spark.read.parquet(_path(table, "state", halfway)), read_sync_state(spark, table)
