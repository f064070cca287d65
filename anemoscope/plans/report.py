"""The report of one clean table."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row

from anemoscope import config
from anemoscope.operators import passes, sheets
from anemoscope.operators.efficiency import efficiency
from anemoscope.operators.summary import headline_stats, narrative
from anemoscope.sources import bundle
from anemoscope.sources.storage import Workspace

WRITERS = 8


@dataclass(frozen=True)
class ReportOptions:
    output: str = "output"
    fmt: str = "parquet"
    sort_rows: bool = False
    day: date | None = None


@dataclass(frozen=True)
class Report:
    """A started report: its folder, the clean table, its days and its headline figures."""

    path: str
    table: DataFrame
    rows: int
    days: DataFrame
    totals: Row
    moments: DataFrame


def start_report(
    clean: DataFrame, rows: int, options: ReportOptions, workspace: Workspace
) -> Report:
    """Write the clean table, and plan the analyses on what was written.

    As Parquet the written member is itself the staged clean table, so the
    cleaning runs once and each analysis scans only the columns it needs.
    """
    shown = sheets.with_display_headers(clean)
    if options.sort_rows:
        keys = [c for c in (config.SOURCE_FILE, "date_time") if c in clean.columns]
        shown = shown.orderBy(*[config.DISPLAY_HEADERS.get(k, k) for k in keys])
    if options.fmt != "parquet":
        clean = workspace.stage(clean, "clean")
        shown = sheets.with_display_headers(clean)
    day = options.day or date.today()
    path = bundle.claim(options.output, "clean_data", shown, options.fmt, day)
    if options.fmt == "parquet":
        written = clean.sparkSession.read.schema(shown.schema).parquet(f"{path}/clean_data")
        clean = written.toDF(*clean.columns)  # by position: names may be alike but for case
    days = workspace.stage(passes.first_pass(clean), "days")
    totals = passes.totals(days)
    return Report(path, clean, rows, days, totals, passes.moments(days, totals))


def finish_report(
    report: Report, quality_log: DataFrame, options: ReportOptions, workspace: Workspace
) -> None:
    """Write the remaining members; the audit member comes last.

    Beside the first pass the clean table is read once for bins and quartiles, and by each
    member that holds its rows.
    """
    # Members do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(WRITERS) as pool:
        jobs = [  # one row per period, used several times
            pool.submit(lambda: workspace.stage(passes.monthly_mean(report.days).coalesce(1), "months")),
            pool.submit(lambda: workspace.stage(passes.daily_total(report.days).coalesce(1), "days-without-gaps")),
            pool.submit(lambda: passes.second_pass(report.table, report.moments, report.totals, report.rows, workspace)),
        ]
        monthly, daily, second = [job.result() for job in jobs]
        members = _members(report, monthly, daily, *second, options)
        written = pool.map(
            lambda member: bundle.write_dataset(
                members[member](), f"{report.path}/{member}", options.fmt
            ),
            members,
        )
        list(written)  # raises what a writer raised
    log = quality_log.orderBy(config.SOURCE_FILE, "step").select(*config.LOG_FIELDS)
    bundle.write_dataset(log, f"{report.path}/data_quality_log", options.fmt)


def _members(report, monthly, daily, described, bins, options) -> dict:
    """How to plan each member; planning some of them runs a small job."""
    table, facts = report.table, passes.headline_facts(report.moments, report.totals)

    def power_curve():
        curve = sheets.with_display_headers(efficiency(table))
        return curve.orderBy(config.DISPLAY_HEADERS["date_time"]) if options.sort_rows else curve

    return {
        "power_curve_analysis": power_curve,
        "charts/theoretical_curve": lambda: sheets.theoretical_curve_chart(table),
        "charts/wind_scatter": lambda: sheets.scatter_chart(table),
        "charts/wind_scatter_density": lambda: sheets.scatter_density(table),
        "summary/stats": lambda: described,
        "summary/narrative": lambda: narrative(facts, monthly),
        "summary/headline_stats": lambda: headline_stats(facts).orderBy("ord"),
        "trend_analysis": lambda: sheets.trend_sheet(monthly, daily).orderBy("section_ord", "ord"),
        "charts/power_trend": lambda: sheets.power_trend_chart(daily),
        "charts/monthly_bar": lambda: sheets.monthly_bar_chart(monthly),
        "wind_bins": lambda: bins,
    }
