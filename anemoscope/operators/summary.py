"""Headline figures and the plain-English paragraph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.numbers import grouped, plain, round_half_even
from anemoscope.operators.efficiency import hours, is_operational, ratio
from anemoscope.operators.timeseries import peak_month


def headline_facts(table: DataFrame) -> DataFrame:
    """All figures of the summary in one scan and one row."""
    operational = F.coalesce(is_operational(), F.lit(False))
    return table.agg(
        F.avg("active_power").alias("mean_power"),
        F.max("active_power").alias("max_power"),
        F.stddev_samp("active_power").alias("std_power"),
        F.avg("wind_speed").alias("mean_speed"),
        F.max("wind_speed").alias("max_speed"),
        (F.avg(F.when(operational, ratio())) * 100).alias("mean_percent"),
        F.count_if(operational).alias("operational_rows"),
        F.count_if(~operational).alias("excluded_rows"),
    )


def headline_stats(facts: DataFrame) -> DataFrame:
    """Eight labelled values, rounded to two decimals where they are not counts."""
    rounded = [
        round_half_even(F.col(name), 2)
        for name in (
            "mean_power", "max_power", "std_power", "mean_speed", "max_speed",
            "mean_percent",
        )
    ]
    counts = [F.col(n).cast("double") for n in ("operational_rows", "excluded_rows")]
    rows = [
        F.struct(F.lit(i).alias("ord"), F.lit(label).alias("metric"), value.alias("value"))
        for i, (label, value) in enumerate(
            zip(config.HEADLINE_LABELS, rounded + counts), start=1
        )
    ]
    return facts.select(F.inline(F.array(*rows)))


def narrative(facts: DataFrame, monthly: DataFrame) -> DataFrame:
    """The summary paragraph.

    The mean power is over all clean rows although the text says operational
    periods: the figure is defined that way.
    """
    peak = peak_month(monthly).select("month_label").scalar()
    text = F.format_string(
        config.NARRATIVE,
        grouped(hours(F.col("operational_rows")), 0),
        grouped(F.col("mean_power"), 1),
        F.coalesce(plain(F.col("mean_percent"), 1), F.lit("nan")),
        peak,
    )
    return facts.select(text.alias("narrative"))
