"""Newsletter signups as a Structured Streaming job.

File source -> validation (stateless) -> streaming ``groupBy(email)``
aggregation in update mode.  The fold per email (oldest brand/country,
newest names, first row's site/page/time) is kept by Spark's state store,
each value stored with the arrival sequence it was seen at, so the result
does not depend on the order files arrive in.  Every micro-batch emits only
the emails it changed; ``foreachBatch`` writes them as one delta folder per
epoch (overwrite, so a replayed epoch rewrites the same delta) and then marks
the epoch.  The table is the newest delta row per email over marked epochs,
read with a map-side-combining aggregate.  Nothing reads or rewrites the
whole state per batch.

Push responses may come as a second stream.  Both streams are one union before
the aggregation, so the same keyed state holds signup and outcome: a response
that arrives before its signup waits in the state, and any interleaving of
files ends in the same table.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from custfold import config as C
from custfold.functions.common import ts_ntz
from custfold.operators import activate, ingest
from custfold.session import ensure_checkpoint_dir
from custfold.streaming import epochs

EPOCH, BASE = "epoch", "base"


def _path(table_dir: str, kind: str, number: int) -> str:
    return f"{table_dir.rstrip('/')}/{kind}={number:09d}"


def _write_delta(table_dir: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("epoch", F.lit(epoch_id).cast("long"))
         .write.mode("overwrite").parquet(_path(table_dir, EPOCH, epoch_id)))
        epochs.mark(batch.sparkSession, table_dir, EPOCH, epoch_id)
    return run


def signup_state_stream(events: DataFrame) -> DataFrame:
    """The streaming per-email state (same aggregate as the batch fold)."""
    return ingest.signup_state(ingest.accept_signups(events), batch=0)


def signup_outcome_state(events: DataFrame, responses: DataFrame) -> DataFrame:
    """One state per email over signups and push responses: the signup fold and
    ``outcome``, the status and detail of the last attempt.  Rows without
    a signup have no ``first_row``."""
    signups = ingest.accept_signups(events).where(F.col("reject_reason").isNull())
    outcomes = activate.push_outcome_signup(responses).select(
        "email", F.struct("attempt", "como_status", "como_detail").alias("outcome"))
    both = signups.withColumn("outcome", F.lit(None).cast(outcomes.schema["outcome"].dataType)).unionByName(outcomes, allowMissingColumns=True)
    # A response row has no sequence number, and brand, country and names are NULL in it.
    folds = ingest.signup_folds(batch=0, present=F.col("seq").isNotNull())
    return both.groupBy("email").agg(*folds, F.max("outcome").alias("outcome"))


def signups_with_outcomes(state: DataFrame, run_ts: _dt.datetime = C.RUN_TS) -> DataFrame:
    """The stored table from a state that carries outcomes."""
    held = state.where(F.col("first_row").isNotNull())
    table = ingest.signups_from_state(held, run_ts, keep=("outcome",))
    sent = F.col("outcome").isNotNull()
    return table.withColumns({"como_status": F.col("outcome.como_status"), "como_detail": F.col("outcome.como_detail"),
                              "como_at": F.when(sent, ts_ntz(run_ts))}).drop("outcome")


def start_signup_stream(spark: SparkSession, source_dir: str, table_dir: str, checkpoint: str,
                        schema, files_per_trigger: int = 100, responses_dir: str | None = None, responses_schema=None) -> StreamingQuery:
    """Start the job over what has landed, with the responses of ``responses_dir``
    if given.  The state of all emails is kept by the session's state store (RocksDB
    by default, on the executors' disks)."""
    def landed(folder, of):
        return spark.readStream.schema(of).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)

    events = landed(source_dir, schema)
    state = signup_state_stream(events) if responses_dir is None else signup_outcome_state(events, landed(responses_dir, responses_schema))
    return (state.writeStream.outputMode("update").foreachBatch(_write_delta(table_dir))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _newest(deltas: DataFrame) -> DataFrame:
    cols = [c for c in deltas.columns if c not in ("email", "epoch")]
    newest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("epoch"))
    return deltas.groupBy("email").agg(newest.alias("_n"), F.max("epoch").alias("epoch")).select("email", "_n.*", "epoch")


def _current(spark: SparkSession, table_dir: str) -> DataFrame:
    base = epochs.marked(spark, table_dir, BASE)
    upto = base[-1] if base else -1
    paths = [_path(table_dir, BASE, upto)] if base else []
    paths += [_path(table_dir, EPOCH, e) for e in epochs.marked(spark, table_dir, EPOCH) if e > upto]
    return _newest(spark.read.parquet(*paths))


def read_signup_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """Current state: per email the newest row among the latest base and the
    epochs after it."""
    return _current(spark, table_dir).drop("epoch")


def compact_signup_table(spark: SparkSession, table_dir: str) -> None:
    """Fold the base and all epochs so far into a new base; readers then open
    the base and newer epochs only.  What the base before it had replaced is
    removed, so a reader that began before this compaction still ends."""
    done, bases = epochs.marked(spark, table_dir, EPOCH), epochs.marked(spark, table_dir, BASE)
    if not done or (bases and bases[-1] >= done[-1]):
        return
    _current(spark, table_dir).write.mode("overwrite").parquet(_path(table_dir, BASE, done[-1]))
    epochs.mark(spark, table_dir, BASE, done[-1])
    if bases:
        for e in [e for e in done if e <= bases[-1]]:
            epochs.remove(spark, _path(table_dir, EPOCH, e))
        for b in bases[:-1]:
            epochs.remove(spark, _path(table_dir, BASE, b))


def run_signup_stream(spark: SparkSession, events: DataFrame, n_files: int = 3) -> DataFrame:
    """Land ``events`` as files in the shared checkpoint folder, stream
    them through the job and return the resulting signup table."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/signup-stream-{uuid.uuid4().hex}"
    src = f"{root}/landed"
    events.repartition(n_files, "event_id").write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_signup_stream(spark, src, f"{root}/table", f"{root}/chk", schema, files_per_trigger=1)
    q.awaitTermination()
    return ingest.signups_from_state(read_signup_table(spark, f"{root}/table"))


def run_signup_outcome_stream(spark: SparkSession, parts: list[tuple[DataFrame | None, DataFrame | None]],
                              run_ts: _dt.datetime = C.RUN_TS) -> DataFrame:
    """Land signups and responses part by part, run the job after each part, and
    return the table (the state goes from one run to the next)."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/signup-outcomes-{uuid.uuid4().hex}"
    signups = next(s for s, _ in parts if s is not None).schema
    responses = next(r for _, r in parts if r is not None).schema
    for name, schema in (("signups", signups), ("responses", responses)):
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
    for s, r in parts:
        for name, df in (("signups", s), ("responses", r)):
            if df is not None:
                df.write.mode("append").parquet(f"{root}/{name}")
        start_signup_stream(spark, f"{root}/signups", f"{root}/table", f"{root}/chk", signups,
                            responses_dir=f"{root}/responses", responses_schema=responses).awaitTermination()
    return signups_with_outcomes(read_signup_table(spark, f"{root}/table"), run_ts)
