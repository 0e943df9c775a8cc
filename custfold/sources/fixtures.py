"""Load the driver tables and expose the derived inputs as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custfold.session import folder_version
from custfold.sources.fixture_sql import FIXTURE_SQL

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations"]

# Which driver tables each derived input reads.
_FIXTURE_BASES = {
    "wifi_guests": ["customer"], "revel_raw": ["orders"],
    "signup_events": ["events"], "prior_master": ["supplier"],
    "push_state": ["customer"], "push_responses": ["customer"],
    "wifi_batch_1": ["customer"], "wifi_batch_2": ["customer"],
    "wifi_json_1": ["customer"], "wifi_json_2": ["customer"],
    "wifi_typed_1": ["customer"], "wifi_typed_2": ["customer"],
    "run_log": ["events"],
}


def spark_fixture_sql(name: str) -> str:
    """The portable fixture text in Spark's identifier quoting."""
    return FIXTURE_SQL[name].replace('AS "Fname"', "AS `Fname`")


def register_base(spark: SparkSession, sf_dir: str, names=None) -> None:
    for name in names or BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


_PLANS: dict = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived input, read lazily from the parquet tables of ``sf_dir``.

    The base tables are registered as temp views scoped to this call's
    ``sf_dir``; the returned plan keeps its own scan nodes, so re-registering
    views for another scale later does not change it.  The lazy plan (not
    data) is reused within a session, which saves re-analysis.
    """
    key = (spark.sparkContext.applicationId, sf_dir, folder_version(spark, sf_dir), name)
    if key not in _PLANS:
        register_base(spark, sf_dir, _FIXTURE_BASES[name])
        _PLANS[key] = spark.sql(spark_fixture_sql(name))
    return _PLANS[key]


def fixtures(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [fixture(spark, sf_dir, n) for n in names]
