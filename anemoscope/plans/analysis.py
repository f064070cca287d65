"""The named results of one clean table."""

from pyspark.sql import DataFrame

from anemoscope.operators.efficiency import efficiency
from anemoscope.operators.statistics import describe
from anemoscope.operators.timeseries import daily_total, monthly_mean
from anemoscope.operators.wind import wind_bins
from anemoscope.sources.storage import Workspace


def analyse(
    table: DataFrame, rows: int | None = None, workspace: Workspace | None = None
) -> dict[str, DataFrame]:
    """The five results by name, each its own lazy plan over the clean table."""
    return {
        "stats": describe(table, rows=rows, workspace=workspace),
        "efficiency": efficiency(table),
        "monthly": monthly_mean(table),
        "daily": daily_total(table),
        "wind_bins": wind_bins(table),
    }
