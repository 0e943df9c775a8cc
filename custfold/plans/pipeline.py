"""End-to-end plans over the derived inputs of one scale directory."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from custfold.operators import ingest, master
from custfold.session import ensure_checkpoint_dir, folder_version
from custfold.sources.fixtures import fixture


_SOURCES: dict = {}


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three stored source tables, derived from the raw feeds (lazy
    plans, built once per session and scale directory)."""
    key = (spark.sparkContext.applicationId, sf_dir, folder_version(spark, sf_dir))
    if key not in _SOURCES:
        _SOURCES[key] = _build_sources(spark, sf_dir)
    return dict(_SOURCES[key])


def _build_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "wifi_guests": fixture(spark, sf_dir, "wifi_guests"),
        "revel_customers": ingest.revel_customers(fixture(spark, sf_dir, "revel_raw")),
        "newsletter_signups": ingest.newsletter_signups(fixture(spark, sf_dir, "signup_events")),
    }


def rebuild(spark: SparkSession, sf_dir: str, with_prior: bool = False) -> master.Rebuild:
    prior = fixture(spark, sf_dir, "prior_master") if with_prior else None
    return master.rebuild_pipeline(stored_sources(spark, sf_dir), prior=prior)


_KEYED: dict = {}


def keyed_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prior master stored by address (bucketed), once per session and
    state of its inputs."""
    key = (spark.sparkContext.applicationId, sf_dir, folder_version(spark, sf_dir))
    if key not in _KEYED:
        name = f"custfold_prior_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
        master.store_keyed(fixture(spark, sf_dir, "prior_master"), name, path)
        _KEYED[key] = name
    return spark.table(_KEYED[key])


def master_table(spark: SparkSession, sf_dir: str, with_prior: bool = False) -> DataFrame:
    """The rebuilt master as a lazy plan."""
    return rebuild(spark, sf_dir, with_prior).master


_STORED: dict = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table written once per session and state of its inputs.

    Written as a parquet table under the shared folder named by
    ``spark.checkpoint.dir`` and read back: lineage is cut (reports do not
    re-run the merge), the files survive the loss of an executor, and
    every report reading it gets column pruning and filter pushdown.
    """
    key = (spark.sparkContext.applicationId, sf_dir, folder_version(spark, sf_dir), name)
    if key not in _STORED:
        root = ensure_checkpoint_dir(spark).rstrip("/")
        safe = "".join(ch if ch.isalnum() else "_" for ch in name)
        path = f"{root}/tables/{safe}-{uuid.uuid4().hex}"
        build().write.mode("overwrite").parquet(path)
        _STORED[key] = spark.read.parquet(path)
    return _STORED[key]


_OVER_PRIOR: list[bool] = [False]


@contextlib.contextmanager
def over_prior():
    """Reports built inside read the master that was merged with a prior."""
    _OVER_PRIOR.append(True)
    try:
        yield
    finally:
        _OVER_PRIOR.pop()


def stored_master(spark: SparkSession, sf_dir: str, with_prior: bool | None = None) -> DataFrame:
    with_prior = _OVER_PRIOR[-1] if with_prior is None else with_prior
    return stored(spark, sf_dir, f"master:{with_prior}", lambda: master_table(spark, sf_dir, with_prior))


# Feeds stored row by row: without a shuffle of their own they keep the files of
# the input, and one small file would be projected by one task.
_ROW_BY_ROW = {"wifi_guests"}


def stored_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table, written when it is asked for."""
    def build() -> DataFrame:
        df = source_tables(spark, sf_dir)[name]
        return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if name in _ROW_BY_ROW else df

    return stored(spark, sf_dir, name, build)


def stored_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {k: stored_source(spark, sf_dir, k) for k in source_tables(spark, sf_dir)}


def push_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "push_state")
