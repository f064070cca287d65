"""The golden answers, and invariants over the test tables."""

import pytest
from conftest import clean_one, write_csv
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.operators import efficiency, sheets, statistics, summary, timeseries, wind
from anemoscope.plans.adapter import scada
from anemoscope.plans.analysis import analyse

SF = "/root/testdata/sf0.001"


@pytest.fixture
def clean_golden(spark, golden):
    return clean_one(spark, golden).table


def test_result_names(clean_golden):
    assert list(analyse(clean_golden)) == ["stats", "efficiency", "monthly", "daily", "wind_bins"]


@pytest.mark.parametrize("buffer_rows", [None, 0])
def test_stats(clean_golden, buffer_rows):
    rows = statistics.describe(clean_golden, buffer_rows=buffer_rows).collect()
    assert [r.statistic for r in rows] == ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    power = [8, 518.5, 380.792126, -2.5, 285.0, 575.25, 765.0, 1000.0]
    speed = [8, 5.7125, 2.360652, 2.0, 4.725, 5.7, 7.25, 9.0]
    assert [r.active_power for r in rows] == pytest.approx(power, abs=1e-6)
    assert [r.wind_speed for r in rows] == pytest.approx(speed, abs=1e-6)


def test_stats_of_a_single_row(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "active_power double, wind_speed double")
    rows = {r.statistic: r.active_power for r in statistics.describe(one).collect()}
    assert rows["std"] is None and rows["50%"] == 1.0


def test_efficiency(clean_golden):
    rows = efficiency.efficiency(clean_golden).orderBy("date_time").collect()
    assert [r.efficiency_ratio for r in rows] == [0.95, 0.901, 1.0, 1.44, 0.9, 1000.0 / 950.0]
    assert efficiency.efficiency(clean_golden).columns == [
        "date_time", "active_power", "wind_speed", "theoretical_power", "efficiency_ratio",
    ]
    counts = efficiency.row_counts(clean_golden).first()
    assert (counts.total_rows, counts.operational_rows, counts.excluded_rows) == (8, 6, 2)
    mean = efficiency.mean_percent(clean_golden).first()[0]
    assert mean == pytest.approx(104.06052631578948)
    assert efficiency.operational_hours(clean_golden).first()[0] == 1


@pytest.mark.parametrize("rows, hours", [(3, 0), (9, 2), (15, 2), (6, 1), (144, 24)])
def test_half_hours_round_to_even(spark, rows, hours):
    assert spark.range(1).select(efficiency.hours(F.lit(rows))).first()[0] == hours


def test_monthly(clean_golden):
    rows = timeseries.monthly_mean(clean_golden).orderBy("period_start").collect()
    assert [str(r.period_start.date()) for r in rows] == ["2018-01-01", "2018-02-01", "2018-03-01"]
    assert rows[0].active_power == pytest.approx(374.666667, abs=1e-6)
    assert rows[1].active_power is None
    assert rows[2].active_power == 950.0
    peak = timeseries.peak_month(timeseries.monthly_mean(clean_golden)).first()
    assert peak.month_label == "March 2018"


def test_peak_month_tie_goes_to_the_earlier(spark):
    months = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2018-02-01', 5D), (timestamp_ntz'2018-01-01', 5D),"
        " (timestamp_ntz'2018-03-01', NULL) AS t(period_start, active_power)"
    )
    assert timeseries.peak_month(months).first().month_label == "January 2018"


def test_daily(clean_golden):
    rows = timeseries.daily_total(clean_golden).collect()
    totals = {str(r.period_start.date()): r.active_power for r in rows}
    assert len(rows) == 64
    expected = {"2018-01-01": 828.0, "2018-01-04": 1420.0, "2018-03-05": 1900.0}
    assert {day: total for day, total in totals.items() if total} == expected
    assert None not in totals.values()


def test_hourly_and_daily_yield(clean_golden):
    hourly = timeseries.hourly_mean(clean_golden).orderBy("period_start").collect()
    assert len(hourly) == 63 * 24 + 24
    assert hourly[0].active_power == pytest.approx(276.0)
    yields = timeseries.mean_daily_yield(timeseries.daily_total(clean_golden))
    rows = yields.orderBy("period_start").collect()
    assert [r.mean_daily_total for r in rows] == pytest.approx([2248 / 31, 0.0, 1900 / 5])


def test_periods_do_not_depend_on_the_session_time_zone(spark, clean_golden):
    expected = timeseries.daily_total(clean_golden).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert timeseries.daily_total(clean_golden).collect() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_wind_bins(clean_golden):
    rows = wind.wind_bins(clean_golden).orderBy("bin_index").collect()
    assert [r["count"] for r in rows] == [2, 1, 0, 2, 0, 0, 0, 0, 0, 0, 0, 1, 0, 1, 0, 1]
    assert rows[0].bin_lower == pytest.approx(-0.36)
    assert rows[0].wind_direction_bin == "(-0.36, 22.5]"
    assert rows[-1].wind_direction_bin == "(337.5, 360.0]"
    assert wind.dominant_direction(wind.wind_bins(clean_golden)).first().bin_index == 1


def test_constant_direction_falls_into_bin_eight(spark, tmp_path):
    rows = "".join(f"2018-01-01 00:0{i}:00,1,1,1,5.0\n" for i in range(4))
    table = clean_one(spark, write_csv(tmp_path / "a.csv", rows)).table
    bins = wind.wind_bins(table).collect()
    assert {r.bin_index: r["count"] for r in bins if r["count"]} == {8: 4}
    assert bins[0].bin_lower == pytest.approx(4.995) and bins[-1].bin_upper == pytest.approx(5.005)


def test_no_direction_gives_sixteen_empty_bins(clean_golden):
    bins = wind.wind_bins(clean_golden.filter("false")).collect()
    assert len(bins) == 16
    assert {r["count"] for r in bins} == {0} and {r.bin_lower for r in bins} == {None}


def test_compass_bins(clean_golden):
    rows = wind.compass_bins(clean_golden).orderBy("bin_index").collect()
    assert rows[0].wind_direction_bin == "(0.0, 22.5]"
    assert sum(r["count"] for r in rows) == 8


def test_headline_and_narrative(clean_golden):
    facts = summary.headline_facts(clean_golden)
    rows = summary.headline_stats(facts).orderBy("ord").collect()
    assert [r.metric for r in rows] == config.HEADLINE_LABELS
    assert [r.value for r in rows] == [518.5, 1000.0, 380.79, 5.71, 9.0, 104.06, 6.0, 2.0]
    text = summary.narrative(facts, timeseries.monthly_mean(clean_golden)).first().narrative
    assert text.startswith("This report analyses 1 hours of operational wind turbine data. ")
    assert "output of 518.5 kW across" in text and "averaged 104.1%, " in text
    assert "occurred in March 2018, " in text


def test_trend_sheet(clean_golden):
    sheet = sheets.trend_sheet(
        timeseries.monthly_mean(clean_golden), timeseries.daily_total(clean_golden)
    ).orderBy("section_ord", "ord").collect()
    assert len(sheet) == 3 + 64
    assert (sheet[0].section, sheet[0].Date) == (config.MONTHLY_SECTION, "2018-01-01")
    assert sheet[0]["Active Power (kW)"] == 374.67
    assert (sheet[3].section, sheet[3].ord) == (config.DAILY_SECTION, 1)


def test_headers_and_charts(clean_golden):
    assert sheets.with_display_headers(clean_golden).columns == [
        "source_file", "Timestamp", "Active Power (kW)", "Wind Speed (m/s)",
        "Theoretical Power (kWh)", "Wind Direction (°)",
    ]
    speeds = [r.wind_speed for r in sheets.theoretical_curve_chart(clean_golden).collect()]
    assert speeds == sorted(speeds) and len(speeds) == 6
    labels = [r.label for r in sheets.monthly_bar_chart(timeseries.monthly_mean(clean_golden)).collect()]
    assert labels == ["Jan 2018", "Feb 2018", "Mar 2018"]
    assert sheets.scatter_chart(clean_golden).count() == 6
    density = sheets.scatter_density(clean_golden)
    assert density.agg(F.sum("points")).first()[0] == 6
    assert sheets.preview(efficiency.efficiency(clean_golden), "date_time").count() == 5


def test_invariants_over_the_tables(spark):
    table = scada(spark, SF)
    rows = table.count()
    counts = efficiency.row_counts(table).first()
    assert counts.operational_rows + counts.excluded_rows == rows
    assert wind.wind_bins(table).agg(F.sum("count")).first()[0] == rows
    ratios = efficiency.efficiency(table)
    assert ratios.filter("theoretical_power <= 0 OR active_power <= 0 OR efficiency_ratio <= 0").count() == 0


def test_filters_and_columns_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "clean")
    scada(spark, SF).write.parquet(path)
    plan = sheets.scatter_chart(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(theoretical_power,0.0)" in plan
    assert "wind_direction" not in plan and "Exchange" not in plan
