
from __future__ import annotations

import contextlib
import io
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles
from anemoscope import config
from anemoscope.functions.text import na_to_null
from anemoscope.operators import (
    cleaning, efficiency, sheets, statistics, summary, timeseries, wind,
)
from anemoscope.operators.cleaning import FILE
from anemoscope.plans import adapter, jobs
from anemoscope.plans.adapter import csv_folder, line_folder, scada, scada_raw, sparse_scada
from anemoscope.plans.report import ReportOptions
from anemoscope.sources import csv_scan, quality_log
from anemoscope.sources.storage import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """The operators for training data and their SQL, where that subpackage is installed."""
    try:
        import corpus_pipeline
        from anemoscope.llm import queries as llm
    except ModuleNotFoundError as missing:
        if (missing.name or "").split(".")[0] not in ("anemoscope", "corpus_pipeline"):
            raise
        return {}, {}
    found = dict(llm.QUERIES) | {"pipeline": corpus_pipeline.run}
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def entry(spark: SparkSession) -> DataFrame:
    """Headline statistics of the smallest data set."""
    return headline_stats(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every operator over the whole tables of a data set."""
    keys = {"efficiency_ratio": "efficiency", "quality_log_rows": "quality_log"}
    return {keys.get(q.__name__, q.__name__): q for q in _QUERIES} | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | _training_data()[1]


def _rounded(table: DataFrame, digits: int, *names: str) -> DataFrame:
    """Floating sums depend on their order in the last bits; compare without them."""
    return table.withColumns({name: F.round(name, digits) for name in names})


# --- Sources ----------------------------------------------------------------------


def _csv_scan(spark, sf_dir, view=scada_raw):
    return csv_scan.scan(spark, csv_scan.list_sources(spark, csv_folder(spark, sf_dir, view)))


def scan_csv(spark, sf_dir):
    return _csv_scan(spark, sf_dir).rows.drop(csv_scan.TOO_LONG)


def na_tokens(spark, sf_dir):
    return adapter.scada_na_tokens(spark, sf_dir).withColumn(
        "wind_speed", na_to_null(F.col("wind_speed"))
    )


def load_counts(spark, sf_dir):
    scan = _csv_scan(spark, sf_dir)
    rows = scan.rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(scan.files.select(FILE, F.col("columns").cast("bigint").alias("columns")), FILE)


def schema_check(spark, sf_dir):
    scan = _csv_scan(spark, sf_dir)
    rows = scan.rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows"))
    valid, missing = F.size("missing") == 0, F.array_join("missing", ", ")
    return rows.join(scan.files.select(FILE, valid.alias("valid"), missing.alias("missing")), FILE)


def _line_scan(spark, sf_dir, view):
    return csv_scan.scan(spark, csv_scan.list_sources(spark, line_folder(spark, sf_dir, view)))


def scan_csv_quoted(spark, sf_dir):
    """Records over several lines, in files cut into several splits."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", 500_000)
    return _line_scan(session, sf_dir, adapter.quoted_lines).rows.drop(csv_scan.TOO_LONG)


def batch_layouts(spark, sf_dir):
    """The clean union of files that all have another header."""
    return cleaning.clean(_line_scan(spark, sf_dir, adapter.layout_lines).rows).table


def schema_check_failures(spark, sf_dir):
    files = _line_scan(spark, sf_dir, adapter.failing_lines).files
    return files.select(
        FILE, (F.size("missing") == 0).alias("valid"), F.array_join("missing", ", ").alias("missing")
    )


def skipped_at_load(spark, sf_dir):
    """Files left out for what they hold; the folder they were written to is not compared."""
    scan = _line_scan(spark, sf_dir, adapter.failing_lines)
    skipped = jobs.skipped_files(scan.files, cleaning.clean(scan.rows).files)
    plain = F.regexp_replace("reason", r"— .*/(farm=\d\.csv)/\S*", "— $1")
    return skipped.withColumn("reason", plain)


def _clean_folder(spark, sf_dir, view):
    scan = _csv_scan(spark, sf_dir, view)
    return scan, cleaning.clean(scan.rows)


def batch_union(spark, sf_dir):
    return _clean_folder(spark, sf_dir, scada_raw)[1].table


def skipped_files(spark, sf_dir):
    scan, result = _clean_folder(spark, sf_dir, adapter.scada_mixed_dates)
    return jobs.skipped_files(scan.files, result.files)


def _report(spark, sf_dir):
    """A whole batch run: the report it wrote."""
    folder = Workspace(spark).path
    options = jobs.JobOptions(ReportOptions(f"{folder}/output"), f"{folder}/log")
    with contextlib.redirect_stdout(io.StringIO()):
        result = jobs.run_batch(spark, csv_folder(spark, sf_dir, scada_raw), options)
    return result.report_path


def report_bundle(spark, sf_dir):
    """A whole batch run; the trend member of the report it wrote."""
    return spark.read.parquet(f"{_report(spark, sf_dir)}/trend_analysis")


_REPORTS: dict[tuple, str] = {}


def _member(spark, sf_dir, name):
    """A member of a report that is written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REPORTS:
        _REPORTS[key] = _report(spark, sf_dir)
    return spark.read.parquet(f"{_REPORTS[key]}/{name}")


def report_clean_data(spark, sf_dir):
    return _member(spark, sf_dir, "clean_data")


def report_headline(spark, sf_dir):
    return _member(spark, sf_dir, "summary/headline_stats")


def report_narrative(spark, sf_dir):
    return _member(spark, sf_dir, "summary/narrative")


def report_statistics(spark, sf_dir):
    return _rounded(_member(spark, sf_dir, "summary/stats"), 4, *statistics.DESCRIBED)


def report_power_curve(spark, sf_dir):
    return _member(spark, sf_dir, "power_curve_analysis")


def report_wind_bins(spark, sf_dir):
    return _member(spark, sf_dir, "wind_bins")


def report_charts(spark, sf_dir):
    """The plotted points of the monthly bars and the daily trend."""
    bars = _member(spark, sf_dir, "charts/monthly_bar")
    trend = _member(spark, sf_dir, "charts/power_trend").withColumn("label", F.lit("day"))
    return bars.unionByName(trend)


def report_quality_log(spark, sf_dir):
    return _member(spark, sf_dir, "data_quality_log").drop("run_id", "run_timestamp")


# --- Cleaning ---------------------------------------------------------------------


def _deduplicated(spark, sf_dir, view=scada_raw):
    raw = view(spark, sf_dir)
    profile = Workspace(spark).stage(cleaning.raw_profile(raw), "raw-profile")
    return profile, cleaning.deduplicate(raw, profile)


def dedup_rows(spark, sf_dir):
    return _deduplicated(spark, sf_dir)[1]


def dedup_spellings(spark, sf_dir):
    """Rows that differ in how their numbers are written, by each file's kind of numbers."""
    rows = _deduplicated(spark, sf_dir, adapter.scada_spellings)[1]
    return rows.select(FILE, "date_time", "active_power", "active_power_invalid")


def duplicate_count(spark, sf_dir):
    return cleaning.duplicate_count(*_deduplicated(spark, sf_dir))


def coerce_numeric(spark, sf_dir):
    return cleaning.coerce_numeric(scada_raw(spark, sf_dir))


def coercion_counts(spark, sf_dir):
    return cleaning.coercion_counts(cleaning.coerce_numeric(scada_raw(spark, sf_dir)))


def drop_critical(spark, sf_dir):
    return cleaning.drop_critical(cleaning.coerce_numeric(scada_raw(spark, sf_dir)))


def null_counts(spark, sf_dir):
    return cleaning.null_counts(cleaning.coerce_numeric(scada_raw(spark, sf_dir)))


def _kept(spark, sf_dir):
    """Rows with both critical values, written once as in a cleaning run."""
    kept = drop_critical(spark, sf_dir)
    kept = kept.drop(*[f"{metric}_invalid" for metric in config.METRICS])
    return Workspace(spark).stage(kept, "kept")


def median_fill(spark, sf_dir):
    kept = _kept(spark, sf_dir)
    medians = Workspace(spark).stage(cleaning.file_medians(kept), "medians")
    return cleaning.fill_medians(kept, medians)


def median_by_brackets(spark, sf_dir):
    """The medians as they are found in files too large for one buffer."""
    return cleaning.file_medians(_kept(spark, sf_dir), buffer_rows=0)


def parse_ts_strict(spark, sf_dir):
    parsed = cleaning.parse_dates(scada_raw(spark, sf_dir))
    return parsed.select(FILE, "date_time", cleaning.DATE_FORMAT, "wind_direction")


def parse_ts_fallback(spark, sf_dir):
    parsed = cleaning.parse_dates(adapter.scada_mixed_dates(spark, sf_dir))
    return parsed.select(FILE, "date_time", cleaning.DATE_FORMAT, "wind_direction")


def parse_ts_forms(spark, sf_dir):
    """The forms that spreadsheets write, each over part of the orders."""
    return cleaning.parse_dates(adapter.scada_date_forms(spark, sf_dir))


def clean_table(spark, sf_dir):
    return cleaning.clean(scada_raw(spark, sf_dir)).table


def clean_table_salted(spark, sf_dir):
    """The same without a broadcast, as with very many files: farms spread over tasks."""
    limits = config.BROADCAST_ROWS, config.ROWS_PER_SALT
    config.BROADCAST_ROWS, config.ROWS_PER_SALT = 0, 1_000
    try:
        return clean_table(spark, sf_dir)
    finally:
        config.BROADCAST_ROWS, config.ROWS_PER_SALT = limits


def clean_counts(spark, sf_dir):
    files = cleaning.clean(scada_raw(spark, sf_dir)).files
    return files.select(
        FILE, "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("dropped")
    )


def quality_log_rows(spark, sf_dir):
    log = cleaning.clean(adapter.scada_mixed_dates(spark, sf_dir)).quality_log
    return log.drop("run_id", "run_timestamp", "step")


def quality_log_for_run(spark, sf_dir):
    """Two runs appended to one log, read back for one file of the second."""
    path = f"{Workspace(spark).path}/log"
    for _ in range(2):
        result = cleaning.clean(scada_raw(spark, sf_dir))
        quality_log.append(result.quality_log, path)
    last = result.files.agg(F.max_by(F.struct("run_id", "run_timestamp"), FILE)).first()[0]
    run_date = last["run_timestamp"][:10]
    return quality_log.read(spark, path, last["run_id"], run_date).drop("run_id", "run_timestamp")


# --- Analysis ----------------------------------------------------------------------


def describe_stats(spark, sf_dir):
    return _rounded(statistics.describe(scada(spark, sf_dir)), 4, *statistics.DESCRIBED)


def describe_by_brackets(spark, sf_dir):
    """The same statistics as they are found in tables too large for one buffer."""
    described = statistics.describe(scada(spark, sf_dir), buffer_rows=0)
    return _rounded(described, 4, *statistics.DESCRIBED)


def operational_rows(spark, sf_dir):
    return efficiency.operational_rows(scada(spark, sf_dir))


def efficiency_excluded(spark, sf_dir):
    return efficiency.row_counts(scada(spark, sf_dir))


def efficiency_ratio(spark, sf_dir):
    return efficiency.efficiency(scada(spark, sf_dir))


def _monthly(spark, sf_dir):
    return timeseries.monthly_mean(scada(spark, sf_dir))


def _daily(spark, sf_dir):
    return timeseries.daily_total(scada(spark, sf_dir))


def monthly_mean(spark, sf_dir):
    return _monthly(spark, sf_dir)


def monthly_mean_gaps(spark, sf_dir):
    return timeseries.monthly_mean(sparse_scada(spark, sf_dir))


def daily_total(spark, sf_dir):
    return _daily(spark, sf_dir)


def daily_total_gaps(spark, sf_dir):
    return timeseries.daily_total(sparse_scada(spark, sf_dir))


def hourly_mean(spark, sf_dir):
    return timeseries.hourly_mean(scada(spark, sf_dir))


def mean_daily_yield(spark, sf_dir):
    return timeseries.mean_daily_yield(_daily(spark, sf_dir))


def wind_bins(spark, sf_dir):
    return wind.wind_bins(scada(spark, sf_dir))


def compass_bins(spark, sf_dir):
    return wind.compass_bins(scada(spark, sf_dir))


def dominant_direction(spark, sf_dir):
    return wind.dominant_direction(wind.wind_bins(scada(spark, sf_dir)))


def mean_efficiency_pct(spark, sf_dir):
    return _rounded(efficiency.mean_percent(scada(spark, sf_dir)), 6, "mean_efficiency_pct")


def operational_hours(spark, sf_dir):
    return efficiency.operational_hours(scada(spark, sf_dir))


def peak_month(spark, sf_dir):
    return timeseries.peak_month(_monthly(spark, sf_dir))


def headline_stats(spark, sf_dir):
    return summary.headline_stats(summary.headline_facts(scada(spark, sf_dir)))


def narrative(spark, sf_dir):
    facts = summary.headline_facts(scada(spark, sf_dir))
    return summary.narrative(facts, _monthly(spark, sf_dir))


# --- Sheets and charts ----------------------------------------------------------------


def preview_efficiency(spark, sf_dir):
    table = efficiency.efficiency(scada(spark, sf_dir))
    return sheets.preview(table, "date_time", "active_power", "wind_speed", "theoretical_power")


def clean_data_sheet(spark, sf_dir):
    return sheets.with_display_headers(scada(spark, sf_dir))


def power_curve_sheet(spark, sf_dir):
    return sheets.with_display_headers(efficiency.efficiency(scada(spark, sf_dir)))


def trend_sheet(spark, sf_dir):
    return sheets.trend_sheet(_monthly(spark, sf_dir), _daily(spark, sf_dir))


def chart_power_trend(spark, sf_dir):
    return sheets.power_trend_chart(_daily(spark, sf_dir))


def chart_scatter(spark, sf_dir):
    return sheets.scatter_chart(scada(spark, sf_dir))


def chart_scatter_density(spark, sf_dir):
    return sheets.scatter_density(scada(spark, sf_dir))


def chart_theoretical_curve(spark, sf_dir):
    return sheets.theoretical_curve_chart(scada(spark, sf_dir))


def chart_monthly_bar(spark, sf_dir):
    return sheets.monthly_bar_chart(_monthly(spark, sf_dir))


_QUERIES = [
    scan_csv, scan_csv_quoted, na_tokens, load_counts, schema_check, schema_check_failures,
    batch_union, batch_layouts, skipped_files, skipped_at_load,
    report_bundle, report_clean_data, report_headline, report_narrative, report_statistics,
    report_power_curve, report_wind_bins, report_charts, report_quality_log, dedup_rows, dedup_spellings, duplicate_count, coerce_numeric, coercion_counts,
    drop_critical, null_counts, median_fill, median_by_brackets,
    parse_ts_strict, parse_ts_fallback, parse_ts_forms, clean_table, clean_table_salted, clean_counts,
    quality_log_rows, quality_log_for_run, describe_stats,
    describe_by_brackets, operational_rows, efficiency_excluded,
    efficiency_ratio, monthly_mean, monthly_mean_gaps, daily_total,
    daily_total_gaps, hourly_mean, mean_daily_yield, wind_bins, compass_bins,
    dominant_direction, mean_efficiency_pct, operational_hours, peak_month,
    headline_stats, narrative, preview_efficiency, clean_data_sheet,
    power_curve_sheet, trend_sheet, chart_power_trend, chart_scatter,
    chart_scatter_density, chart_theoretical_curve, chart_monthly_bar,
]
