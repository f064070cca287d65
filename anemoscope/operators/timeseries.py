"""Active power per calendar period, with every period between first and last."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemoscope.functions.dates import start_of

PERIOD = "period_start"


def resample(table: DataFrame, unit: str, aggregate: Column, empty: Column) -> DataFrame:
    """One row per hour, day or month; ``empty`` is the value of a gap.

    Rows are combined per period before the shuffle. Gaps are filled on the
    aggregated periods alone: each period is followed by the empty ones up to
    the next. The unpartitioned window sees at most one row per period of the
    calendar, never the readings.
    """
    periods = table.groupBy(start_of(unit, F.col("date_time")).alias(PERIOD)).agg(
        aggregate.alias("active_power")
    )
    return with_gaps(periods, unit, empty)


def with_gaps(periods: DataFrame, unit: str, empty: Column) -> DataFrame:
    """One row per period, with the empty ones between those that have readings."""
    following = F.lead(PERIOD).over(Window.orderBy(PERIOD))
    step = F.expr(f"interval 1 {unit}")
    last = F.coalesce(F.col("following") - step, F.col(PERIOD))
    filled = periods.withColumn("following", following).select(
        "active_power", F.posexplode(F.sequence(PERIOD, last, step)).alias("gap", PERIOD)
    )
    value = F.when(F.col("gap") == 0, F.col("active_power")).otherwise(empty)
    return filled.select(PERIOD, value.alias("active_power"))


def monthly_mean(table: DataFrame) -> DataFrame:
    """Mean active power per month; a month without readings is null."""
    return resample(table, "month", F.avg("active_power"), F.lit(None).cast("double"))


def daily_total(table: DataFrame) -> DataFrame:
    """Total active power per day; a day without readings is 0."""
    total = F.coalesce(F.sum("active_power"), F.lit(0.0))
    return resample(table, "day", total, F.lit(0.0))


def hourly_mean(table: DataFrame) -> DataFrame:
    """Mean active power per hour; an hour without readings is null."""
    return resample(table, "hour", F.avg("active_power"), F.lit(None).cast("double"))


def mean_daily_yield(daily: DataFrame) -> DataFrame:
    """Average of the daily totals per month."""
    return daily.groupBy(start_of("month", F.col(PERIOD)).alias(PERIOD)).agg(
        F.avg("active_power").alias("mean_daily_total")
    )


def peak_month(monthly: DataFrame) -> DataFrame:
    """The month with the highest mean, the earliest if several share it."""
    return (
        monthly.filter(F.col("active_power").isNotNull())
        .orderBy(F.col("active_power").desc(), F.col(PERIOD))
        .limit(1)
        .select(
            PERIOD,
            "active_power",
            F.date_format(PERIOD, "MMMM yyyy").alias("month_label"),
        )
    )
