"""Point lookup of one address (or a few) over large tables.

``store_lookup`` writes a table in the order of its lower-case address, with a
Parquet bloom filter on it.  A lookup then is a filter with literals: the
pushed filter skips every row group whose range or bloom filter excludes the
address, so its cost does not grow with the table.  Rows come back whole and
typed, table by table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOOKUP_KEY = "lookup_email"


def store_lookup(df: DataFrame, path: str, email_col: str = "email", rows_per_file: int = 5_000_000) -> DataFrame:
    """Write ``df`` sorted by lower-case address (rows without one come first)
    with bloom filters, and read it back.  Equal addresses are spread by a
    hash of their row, so a hot address does not fill one file."""
    keyed = df.withColumn(LOOKUP_KEY, F.lower(F.col(email_col)))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    (keyed.repartitionByRange(LOOKUP_KEY, spread).sortWithinPartitions(LOOKUP_KEY)
     .write.option(f"parquet.bloom.filter.enabled#{LOOKUP_KEY}", "true").option("maxRecordsPerFile", rows_per_file).parquet(path))
    return df.sparkSession.read.parquet(path)


def lookup(table: DataFrame, addresses: list[str], most: int = 1000) -> DataFrame:
    """The rows of a stored lookup table for the addresses asked for (as typed by
    a user: trimmed, any case).  More than ``most`` addresses are refused: join
    ``customer_rows`` for those."""
    asked = sorted({a.strip().lower() for a in addresses if a and a.strip()})
    if len(asked) > most:
        raise ValueError(f"a lookup takes at most {most} addresses")
    return table.where(F.col(LOOKUP_KEY).isin(asked)).drop(LOOKUP_KEY)


def customer(spark: SparkSession, tables: dict[str, DataFrame], addresses: list[str]) -> dict[str, DataFrame]:
    """Everything known of the addresses: table name -> whole rows."""
    return {name: lookup(t, addresses) for name, t in tables.items()}
