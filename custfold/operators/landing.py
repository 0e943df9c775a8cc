"""A landed feed that incremental loads read in part.

The feed lies in folders by brand and period of ``updated_date`` (a month unless
asked otherwise).  ``landed_periods`` lists the folders that exist (a scan of
footers only); joined with the state of the brands it gives the folders a run
needs, and the equality join on both partition columns lets Spark prune the
scan at run time (dynamic partition pruning), whatever the state holds.
Nothing of the state passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH = "yyyy-MM"
#: Folder of rows without a date; periods begin with a digit.
NO_DATE = "none"
_STAMP = "try_cast(CAST(updated_date AS STRING) AS TIMESTAMP_NTZ)"


def land(feed: DataFrame, path: str, brand_col: str = "_brand", period: str = MONTH) -> None:
    """Write the feed in folders ``feed_brand`` and ``feed_period``.  Rows of a folder
    come together (large folders are split again), so that it holds few files."""
    named = feed.withColumns({"feed_brand": F.col(brand_col), "feed_period": F.coalesce(F.date_format(F.expr(_STAMP), period), F.lit(NO_DATE))})
    named.hint("rebalance", "feed_brand", "feed_period").write.partitionBy("feed_brand", "feed_period").parquet(path)


def landed_periods(landed: DataFrame) -> DataFrame:
    """``feed_brand, feed_period, rows``: the folders of a landed feed."""
    return landed.groupBy("feed_brand", "feed_period").agg(F.count(F.lit(1)).alias("rows"))


def wanted_periods(periods: DataFrame, state: DataFrame, period: str = MONTH) -> DataFrame:
    """``_brand_folder, _period_folder, _since``: the folders of a run.  Brands with
    a complete backfill and a mark need those from a day before the mark on; all
    others need every folder (``_since`` is NULL)."""
    marks = state.select(F.col("brand").alias("_st_brand"),
                         F.when(F.col("backfill_complete"), F.col("watermark") - F.expr("INTERVAL 1 DAY")).alias("_since"))
    both = periods.join(marks, F.col("feed_brand") == F.col("_st_brand"), "left")
    first = F.coalesce(F.date_format("_since", period), F.lit(""))
    end = F.when(F.col("_since").isNull(), F.lit("~")).otherwise(F.lit(":"))  # ':' follows the digits
    return (both.where((F.col("feed_period") >= first) & (F.col("feed_period") < end))
            .select(F.col("feed_brand").alias("_brand_folder"), F.col("feed_period").alias("_period_folder"), "_since"))


def slice_landed(landed: DataFrame, periods: DataFrame, state: DataFrame, period: str = MONTH) -> DataFrame:
    """The rows of ``incremental_slice`` from a landed feed; only the folders of
    ``wanted_periods`` are read."""
    wanted = wanted_periods(periods, state, period)
    same = (F.col("feed_brand") == F.col("_brand_folder")) & (F.col("feed_period") == F.col("_period_folder"))
    fresh = F.col("_since").isNull() | F.coalesce(F.expr(_STAMP) >= F.col("_since"), F.lit(False))
    return (landed.join(wanted, same).where(F.col("email").contains("@") & fresh)
            .drop("feed_brand", "feed_period", "_brand_folder", "_period_folder", "_since"))
