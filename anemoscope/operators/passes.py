"""Two passes over a clean table from which all small results of a report follow.

The first counts and sums per day, and keeps squared deviations and extremes; headline
figures, moments, periods and the range of wind directions are combined from its rows, one a
day. The second counts the wind bins between the edges known by then, and collects the
quartiles where one buffer holds them.
"""

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.dates import start_of
from anemoscope.operators import statistics, timeseries, wind
from anemoscope.operators.efficiency import is_operational, ratio
from anemoscope.operators.quantiles import buffered, exact_quantiles
from anemoscope.operators.timeseries import PERIOD
from anemoscope.sources.storage import Workspace

DESCRIBED = statistics.DESCRIBED


def first_pass(table: DataFrame) -> DataFrame:
    """One row per day with what the days are combined from."""
    operational = F.coalesce(is_operational(), F.lit(False))
    facts = [
        F.count_if(operational).alias("operational_rows"),
        F.count_if(~operational).alias("excluded_rows"),
        F.sum(F.when(operational, ratio())).alias("ratios"),
        F.count(F.when(operational, ratio())).alias("ratio_rows"),
        F.min("wind_direction").alias("least_direction"),
        F.max("wind_direction").alias("most_direction"),
    ]
    for name in DESCRIBED:
        facts += [
            F.count(name).alias(f"{name}_count"), F.sum(name).alias(f"{name}_sum"),
            F.min(name).alias(f"{name}_min"), F.max(name).alias(f"{name}_max"),
            (F.var_pop(name) * F.count(name)).alias(f"{name}_squares"),
        ]
    return table.groupBy(start_of("day", F.col("date_time")).alias(PERIOD)).agg(*facts)


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))


def totals(days: DataFrame) -> Row:
    """What all days have together, but for the deviations from the means found here."""
    return days.agg(
        *[_mean(name).alias(f"mean{i}") for i, name in enumerate(DESCRIBED)],
        (F.try_divide(F.sum("ratios"), F.sum("ratio_rows")) * 100).alias("mean_percent"),
        F.coalesce(F.sum("operational_rows"), F.lit(0)).alias("operational_rows"),
        F.coalesce(F.sum("excluded_rows"), F.lit(0)).alias("excluded_rows"),
        F.min("least_direction").alias("low"), F.max("most_direction").alias("high"),
    ).first()


def moments(days: DataFrame, known: Row) -> DataFrame:
    """Count, mean, sample deviation and extremes of the described columns, in one row."""
    facts = []
    for i, name in enumerate(DESCRIBED):
        # Deviations from the mean of all days: those within a day and that of its own mean.
        mean = F.lit(known[f"mean{i}"]).cast("double")
        own = F.try_divide(f"{name}_sum", f"{name}_count") - mean
        squares = F.sum(F.col(f"{name}_squares") + F.col(f"{name}_count") * own * own)
        count = F.sum(f"{name}_count")
        facts += [
            F.coalesce(count, F.lit(0)).cast("double").alias(f"count{i}"), mean.alias(f"mean{i}"),
            F.when(count > 1, F.sqrt(squares / (count - 1))).alias(f"std{i}"),
            F.min(f"{name}_min").alias(f"min{i}"), F.max(f"{name}_max").alias(f"max{i}"),
        ]
    return days.agg(*facts)


def headline_facts(row_of_moments: DataFrame, known: Row) -> DataFrame:
    """The figures of the summary, as ``summary.headline_facts`` has them."""
    power, speed = DESCRIBED.index("active_power"), DESCRIBED.index("wind_speed")
    return row_of_moments.select(
        F.col(f"mean{power}").alias("mean_power"), F.col(f"max{power}").alias("max_power"),
        F.col(f"std{power}").alias("std_power"), F.col(f"mean{speed}").alias("mean_speed"),
        F.col(f"max{speed}").alias("max_speed"),
        F.lit(known["mean_percent"]).cast("double").alias("mean_percent"),
        *[F.lit(known[n]).cast("bigint").alias(n) for n in ("operational_rows", "excluded_rows")],
    )


def monthly_mean(days: DataFrame) -> DataFrame:
    """Mean active power per month; a month without readings is null."""
    months = days.groupBy(start_of("month", F.col(PERIOD)).alias(PERIOD)).agg(
        _mean("active_power").alias("active_power")
    )
    return timeseries.with_gaps(months, "month", F.lit(None).cast("double"))


def daily_total(days: DataFrame) -> DataFrame:
    """Total active power per day; a day without readings is 0."""
    total = F.coalesce("active_power_sum", F.lit(0.0)).alias("active_power")
    return timeseries.with_gaps(days.select(PERIOD, total), "day", F.lit(0.0))


def second_pass(
    table: DataFrame, row_of_moments: DataFrame, known: Row, rows: int, workspace: Workspace,
    buffer_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The statistics and the wind bins."""
    edges = wind.observed_edges(known["low"], known["high"])
    quartiles = []
    fits = rows <= (config.QUANTILE_BUFFER_ROWS if buffer_rows is None else buffer_rows)
    if fits:
        quartiles = buffered(DESCRIBED, config.QUARTILES)
    found = table.agg(*wind.counts_beyond(edges), *quartiles).first()
    counts = {name: found[name] for name in found.asDict() if name.startswith("beyond")}
    if fits:
        arrays = {name: found[name] for name in DESCRIBED}
    else:
        arrays = exact_quantiles(
            table, [], DESCRIBED, config.QUARTILES, rows, workspace=workspace, buffer_rows=buffer_rows
        ).first().asDict()
    spark = table.sparkSession
    described = statistics.in_rows(_with_arrays(row_of_moments, arrays))
    counted = spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in counts.items()])
    return described, wind.binned(counted, edges)


def _with_arrays(row: DataFrame, arrays: dict) -> DataFrame:
    missing = F.lit(None).cast("array<double>")
    named = [
        (F.lit(value).cast("array<double>") if value is not None else missing).alias(name)
        for name, value in arrays.items()
    ]
    return row.select("*", *named)
