"""Tables laid out for readers: display headers, rounding, sections, charts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.numbers import round_half_even
from anemoscope.operators.efficiency import operational_rows
from anemoscope.operators.timeseries import PERIOD

SPEED_CELL = 0.1
POWER_CELL = 10.0


def display_names(columns: list[str]) -> list[str]:
    """Display names of known columns; others keep their own unless it is one of those,
    in any case, and then get a numbered suffix."""
    known = {c: config.DISPLAY_HEADERS[c] for c in columns if c in config.DISPLAY_HEADERS}
    taken = {name.lower() for name in known.values()} | {
        c.lower() for c in columns if c not in known
    }
    shown = {name.lower() for name in known.values()}
    names = []
    for column in columns:
        name, repeat = known.get(column, column), 0
        if column not in known and column.lower() in shown:
            while name.lower() in taken:
                repeat += 1
                name = f"{column}.{repeat}"
            taken.add(name.lower())
        names.append(name)
    return names


def with_display_headers(table: DataFrame) -> DataFrame:
    """The table under its display names."""
    return table.toDF(*display_names(table.columns))


def trend_sheet(monthly: DataFrame, daily: DataFrame) -> DataFrame:
    """The monthly section, then the daily one, each in date order."""
    return _section(1, config.MONTHLY_SECTION, monthly).unionByName(
        _section(2, config.DAILY_SECTION, daily)
    )


def _section(number: int, title: str, periods: DataFrame) -> DataFrame:
    # One row per calendar period, so one window over them all is small.
    position = F.row_number().over(Window.orderBy(PERIOD))
    return periods.select(
        F.lit(number).alias("section_ord"),
        F.lit(title).alias("section"),
        position.alias("ord"),
        F.date_format(PERIOD, "yyyy-MM-dd").alias("Date"),
        round_half_even(F.col("active_power"), 2).alias("Active Power (kW)"),
    )


def preview(table: DataFrame, *order: str) -> DataFrame:
    """The first five rows in a stated order."""
    return table.orderBy(*order).limit(5)


def power_trend_chart(daily: DataFrame) -> DataFrame:
    return daily.orderBy(PERIOD)


def scatter_chart(table: DataFrame) -> DataFrame:
    """One point per operational row."""
    return operational_rows(table).select("wind_speed", "active_power")


def scatter_density(table: DataFrame) -> DataFrame:
    """The scatter as counts per grid cell, small enough to draw at any scale."""
    return (
        scatter_chart(table)
        .groupBy(
            F.floor(F.col("wind_speed") / SPEED_CELL).alias("speed_cell"),
            F.floor(F.col("active_power") / POWER_CELL).alias("power_cell"),
        )
        .agg(F.count(F.lit(1)).alias("points"))
    )


def theoretical_curve_chart(table: DataFrame) -> DataFrame:
    """Theoretical power by wind speed; the date keeps equal speeds apart."""
    return (
        operational_rows(table)
        .select("wind_speed", "date_time", "theoretical_power")
        .orderBy("wind_speed", "date_time")
    )


def monthly_bar_chart(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        PERIOD, F.date_format(PERIOD, "MMM yyyy").alias("label"), "active_power"
    ).orderBy(PERIOD)
