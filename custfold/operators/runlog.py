"""The run log, written by the jobs themselves.

A job's counts are ``Observation`` metrics: they are gathered in the pass that
writes the result, so logging costs no second scan.  Every run appends one row
to the log, also a run that fails.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from custfold import config as C
from custfold.functions.email import reason_class
from custfold.operators import ingest, master

LOG_SCHEMA = "id string, job string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, error string, metrics string"


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], mode: str = "error") -> dict:
    """Write ``df`` and return ``metrics`` of the rows written."""
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in metrics.items()]).write.mode(mode).parquet(path)
    return dict(seen.get)


def logged(spark: SparkSession, log_path: str, job: str, run: Callable[[], dict],
           clock: Callable[[], _dt.datetime] = lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)) -> dict:
    """Run a job and append its row to the log; its metrics are what it returns.
    A failure is logged and raised again."""
    started, metrics, error = clock(), {}, None
    try:
        metrics = run()
        return metrics
    except Exception as e:
        error = f"{type(e).__name__}: {e}"[:2000]
        raise
    finally:
        row = (uuid.uuid4().hex, job, started, clock(), "failed" if error else "ok", error, json.dumps(metrics, sort_keys=True, default=str))
        spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def log_metrics(log: DataFrame) -> DataFrame:
    """``id, job, started_at, status, metric, n``: the logged counts as rows."""
    counts = F.explode_outer(F.from_json("metrics", "map<string,bigint>")).alias("metric", "n")
    return log.select("id", "job", "started_at", "status", counts)


def ingest_pos_logged(spark: SparkSession, raw: DataFrame, path: str, log_path: str) -> dict:
    """Classify a feed, write its rows that are stored, log what became of all."""
    typed = ingest.ingest_pos_customers(raw)
    cls = reason_class(F.col("email_reason"))
    gone = F.coalesce(cls.isin(list(C.DISCARD_REASONS)), F.lit(False))

    def run() -> dict:
        seen = Observation()
        outcome = {"rows": F.count(F.lit(1)), "discarded": F.count_if(gone), "ok": F.count_if(F.col("email_ok") & ~gone),
                   "rejected": F.count_if(~F.col("email_ok") & ~gone)}
        rows = typed.observe(seen, *[c.alias(n) for n, c in outcome.items()])
        # Discarded by a flag that only exists above the observation, so no row is dropped below it.
        rows.withColumn("_gone", gone).where(~F.col("_gone")).drop("_gone", "email_reason_pre").write.parquet(path)
        return dict(seen.get)

    return logged(spark, log_path, "revel", run)


def rebuild_logged(spark: SparkSession, sources: dict, path: str, log_path: str, registry=None, prior: DataFrame | None = None) -> dict:
    """Merge the sources, write the merged rows, log rows merged per source."""
    def run() -> dict:
        result = master.merge_sources(sources, registry, prior)
        metrics = {s.source_table: F.count_if(F.col(f"_applied_{r}")) for r, s in result.present}
        return write_observed(result.master, path, {**metrics, "people": F.count(F.lit(1)), "changed": F.count_if(F.col("_changed"))})

    return logged(spark, log_path, "master", run)
