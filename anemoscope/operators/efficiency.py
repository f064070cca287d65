"""Power-curve efficiency of operational rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.numbers import round_half_even

RATIO = "efficiency_ratio"


def is_operational() -> Column:
    """Both the theoretical and the actual power are positive."""
    return (F.col("theoretical_power") > config.MIN_THEORETICAL_POWER) & (
        F.col("active_power") > config.MIN_ACTIVE_POWER
    )


def ratio() -> Column:
    return F.try_divide("active_power", "theoretical_power")


def operational_rows(table: DataFrame) -> DataFrame:
    return table.filter(is_operational())


def efficiency(table: DataFrame) -> DataFrame:
    """Operational rows with their ratio; a ratio above one is valid."""
    return operational_rows(table).select(
        "date_time", "active_power", "wind_speed", "theoretical_power",
        ratio().alias(RATIO),
    )


def row_counts(table: DataFrame) -> DataFrame:
    """Rows in all, operational, and excluded; null power counts as excluded."""
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_operational()).alias("operational_rows"),
        F.count_if(~F.coalesce(is_operational(), F.lit(False))).alias("excluded_rows"),
    )


def mean_percent(table: DataFrame) -> DataFrame:
    """Mean of the ratios, not ratio of the sums, in percent."""
    return operational_rows(table).agg(
        (F.avg(ratio()) * 100).alias("mean_efficiency_pct")
    )


def hours(rows: Column) -> Column:
    """Whole hours covered by a number of ten-minute readings."""
    return round_half_even(rows * config.SAMPLE_MINUTES / F.lit(60)).cast("bigint")


def operational_hours(table: DataFrame) -> DataFrame:
    counted = operational_rows(table).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(hours(F.col("rows")).alias("operational_hours"))
