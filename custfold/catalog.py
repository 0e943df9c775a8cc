"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the driver tables of that
directory (through the derived inputs), so its work grows with the data.
Array columns are surfaced as comma-joined text so both engines compare
equal; counts are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def master_view(df: DataFrame) -> DataFrame:
    """Master rows with arrays as text (the compared form)."""
    return df.select("email", "first_name", "last_name", "nationality", "birthday",
                     F.array_join("tags", ",").alias("tags"), "src_system", "brand", "country",
                     "venue", "allow_email", "email_key", "duplicate_of", "dup_reason",
                     F.array_join("sources", ",").alias("sources"), "needs_push")


def load_all() -> None:
    """Import the modules that register queries."""
    from custfold.plans import queries_core  # noqa: F401
    from custfold.plans import queries_reports  # noqa: F401
    from custfold.plans import queries_activate  # noqa: F401
    from custfold.plans import queries_ingest  # noqa: F401
