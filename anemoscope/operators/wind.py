"""Distribution of the wind direction over equal-width bins."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoscope import config

BINS = config.WIND_DIRECTION_BINS


def wind_bins(table: DataFrame) -> DataFrame:
    """Sixteen right-closed bins between the observed extremes, none left out.

    Two scans of one column: the extremes, one row that becomes literals, then
    one count per edge of the readings beyond it. No reading is shuffled.
    Without any reading the edges are null and every count is zero.
    """
    low, high = table.agg(F.min("wind_direction"), F.max("wind_direction")).first()
    return _count_bins(table, observed_edges(low, high))


def compass_bins(table: DataFrame) -> DataFrame:
    """The same count over fixed bins of 22.5 degrees from 0 to 360.

    The first bin takes in 0 itself, as the lowest observed edge does above.
    """
    edges = [k * 360.0 / BINS for k in range(BINS + 1)]
    return _count_bins(table, edges, closed_below=True)


def dominant_direction(bins: DataFrame) -> DataFrame:
    """The fullest bin, the lowest if several are equally full."""
    return bins.orderBy(F.col("count").desc(), "bin_index").limit(1)


def observed_edges(low: float | None, high: float | None) -> list:
    """Edges of equal steps; the lowest moves down to take in the minimum.

    A single observed value is widened to a range around itself.
    """
    if low is None:
        return [None] * (BINS + 1)
    if low == high:
        margin = 0.001 * abs(low) if low else 0.001
        low, high = low - margin, high + margin
        lowest = low
    else:
        lowest = low - (high - low) * 0.001
    width = (high - low) / BINS
    return [lowest, *[low + k * width for k in range(1, BINS)], high]


def _count_bins(table, edges, closed_below=False):
    return binned(table.agg(*counts_beyond(edges, closed_below)), edges)


def counts_beyond(edges: list, closed_below: bool = False) -> list:
    """Aggregates that count the readings beyond each edge."""
    direction = F.col("wind_direction")
    limits = [F.lit(edge).cast("double") for edge in edges]
    inside = direction >= limits[0] if closed_below else direction > limits[0]
    beyond = [F.count_if(inside).alias("beyond0")]
    beyond += [
        F.count_if(direction > limit).alias(f"beyond{k}")
        for k, limit in enumerate(limits[1:], start=1)
    ]
    return beyond


def binned(counts: DataFrame, edges: list) -> DataFrame:
    """The bins between edges, from the one row of counts beyond them."""
    limits = [F.lit(edge).cast("double") for edge in edges]
    rows = [
        F.struct(
            F.lit(k + 1).alias("bin_index"),
            limits[k].alias("bin_lower"),
            limits[k + 1].alias("bin_upper"),
            F.lit(_label(edges[k], edges[k + 1])).alias("wind_direction_bin"),
            (F.col(f"beyond{k}") - F.col(f"beyond{k + 1}")).alias("count"),
        )
        for k in range(BINS)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _label(lower, upper):
    if lower is None:
        return None
    return f"({_short(lower)}, {_short(upper)}]"


def _short(edge: float) -> float:
    """Three decimals, or three significant digits below one."""
    digits = 3
    if 0 < abs(edge) < 1:
        digits = 2 - math.floor(math.log10(abs(edge)))
    return round(edge * 10**digits) / 10**digits
