"""Descriptive statistics of active power and wind speed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.text import col
from anemoscope.operators.lookup import with_values
from anemoscope.operators.quantiles import buffered, exact_quantiles
from anemoscope.sources.storage import Workspace

DESCRIBED = ["active_power", "wind_speed"]


def describe(
    table: DataFrame,
    columns: list[str] = DESCRIBED,
    rows: int | None = None,
    workspace: Workspace | None = None,
    buffer_rows: int | None = None,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum.

    Eight rows, one DOUBLE column per metric. A table within the buffer bound
    takes one aggregate; a larger one finds its quartiles by brackets first.
    """
    buffer_rows = config.QUANTILE_BUFFER_ROWS if buffer_rows is None else buffer_rows
    rows = table.count() if rows is None else rows
    moments = []
    for i, c in enumerate(columns):
        moments += [
            F.count(col(c)).cast("double").alias(f"count{i}"),
            F.avg(col(c)).alias(f"mean{i}"),
            F.stddev_samp(col(c)).alias(f"std{i}"),
            F.min(col(c)).alias(f"min{i}"),
            F.max(col(c)).alias(f"max{i}"),
        ]
    if rows <= buffer_rows:
        facts = table.agg(*moments, *buffered(columns, config.QUARTILES))
    else:
        quartiles = exact_quantiles(
            table, [], columns, config.QUARTILES, rows,
            workspace=workspace, buffer_rows=buffer_rows,
        )
        facts = with_values(table.agg(*moments), quartiles.first())
    return in_rows(facts, columns)


def in_rows(facts: DataFrame, columns: list[str] = DESCRIBED) -> DataFrame:
    """The eight rows out of one row of moments and arrays of quartiles."""
    return facts.select(F.inline(F.array(*_statistics(columns))))


def _statistics(columns):
    def row(name, value):
        cells = [value(i, c).alias(c) for i, c in enumerate(columns)]
        return F.struct(F.lit(name).alias("statistic"), *cells)

    def moment(name):
        return row(name, lambda i, c: F.col(f"{name}{i}"))

    def quartile(name, position):
        return row(name, lambda i, c: col(c)[position])

    return [
        moment("count"), moment("mean"), moment("std"), moment("min"),
        quartile("25%", 0), quartile("50%", 1), quartile("75%", 2),
        moment("max"),
    ]
