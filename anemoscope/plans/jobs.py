"""Single-file and batch runs, and the command line in front of them."""

import argparse
import sys
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.errors import ReportError
from anemoscope.operators import sheets
from anemoscope.operators.cleaning import FILE, CleanResult, clean, quality_log
from anemoscope.plans.analysis import analyse
from anemoscope.plans.report import ReportOptions, finish_report, start_report
from anemoscope.sources import bundle, csv_scan, storage
from anemoscope.sources import quality_log as log_table
from anemoscope.sources.csv_scan import Scan
from anemoscope.sources.storage import Workspace

PREVIEW_ORDER = {
    "stats": (), "efficiency": ("date_time",), "monthly": ("period_start",),
    "daily": ("period_start",), "wind_bins": ("bin_index",),
}


@dataclass(frozen=True)
class JobOptions:
    report: ReportOptions = field(default_factory=ReportOptions)
    log: str = "logs/data_quality_log"
    dayfirst: bool = False
    preview: bool = False
    flag_skipped: bool = False


@dataclass(frozen=True)
class JobResult:
    report_path: str
    last_run_id: str
    rows: int


class _Stage:
    """Turn an unforeseen failure of one stage into one plain message."""

    def __init__(self, name: str):
        self.name = name

    def __enter__(self):
        return self

    def __exit__(self, kind, error, trace):
        if isinstance(error, Exception) and not isinstance(error, ReportError):
            first_line = str(error).splitlines()[0] if str(error) else kind.__name__
            raise ReportError(
                f"Unexpected error during {self.name}: {first_line}", self.name
            ) from error
        return False


def run_single(
    spark: SparkSession, path: str, options: JobOptions | None = None
) -> JobResult:
    """Load, clean, analyse and report one CSV source."""
    with Workspace(spark) as workspace:
        return _single(spark, path, options or JobOptions(), workspace)


def _single(spark, path, options, workspace) -> JobResult:
    with _Stage("ingestion"):
        bundle.check_output(spark, [path], options.report.output, options.log)
        scan = csv_scan.scan(spark, csv_scan.list_source(spark, path), workspace)
        for reason in scan.rejected.values():
            raise ReportError(reason, "load")
    with _Stage("cleaning"):
        result = _clean(spark, scan, options, workspace)
        facts = _with_columns(result, scan).first()
        if facts["stage"] == "load":
            raise ReportError(facts["reason"], "load")
        _say_counts(facts)
        if facts["stage"] == "clean":
            log_table.append(result.quality_log, options.log)
            raise ReportError(facts["reason"], "clean")
        table = result.table.drop(FILE)
    return _report(table, result, facts["rows_out"], options, workspace)


def run_batch(
    spark: SparkSession, folder: str, options: JobOptions | None = None
) -> JobResult:
    """Clean every CSV source of a folder and report on all of them together.

    All files run in one job keyed by ``source_file``; a file that fails is
    named with its reason and the others go on.
    """
    with Workspace(spark) as workspace:
        return _batch(spark, folder, options or JobOptions(), workspace)


def _batch(spark, folder, options, workspace) -> JobResult:
    with _Stage("ingestion"):
        sources = csv_scan.list_sources(spark, folder)
        inputs = csv_scan.inputs_holding(spark, folder, [options.report.output, options.log])
        bundle.check_output(spark, inputs, options.report.output, options.log)
        print(config.FOUND_FILES.format(count=sources.count, folder=folder))
        scan = csv_scan.scan(spark, sources, workspace)
    if scan.rows is None:
        _say_skipped(scan.rejected)
        raise ReportError(config.NOTHING_PROCESSED, "clean")
    with _Stage("cleaning"):
        result = _clean(spark, scan, options, workspace)
        _say_skipped(scan.rejected)
        for facts in _with_columns(result, scan).orderBy(FILE).toLocalIterator():
            print(config.PROCESSING.format(name=facts[FILE]))
            if facts["stage"] != "load":
                _say_counts(facts)
            if facts["stage"] is not None:
                print(config.SKIPPED.format(name=facts[FILE], reason=facts["reason"]))
        good = result.files.filter(F.col("stage").isNull())
        totals = good.agg(F.count(F.lit(1)).alias("files"), F.sum("rows_out").alias("rows")).first()
        if not totals["files"]:
            log_table.append(result.quality_log, options.log)
            raise ReportError(config.NOTHING_PROCESSED, "clean")
        table = result.table
    print(config.CONCATENATING.format(count=totals["files"]))
    print(config.CONSOLIDATED.format(rows=totals["rows"]))
    return _report(table, result, totals["rows"], options, workspace)


def skipped_files(sources: DataFrame, files: DataFrame) -> DataFrame:
    """Every file left out, the stage it failed in, and why."""
    at_load = sources.where("reason IS NOT NULL").select(FILE, F.lit("load").alias("stage"), "reason")
    return at_load.unionByName(files.where("stage IS NOT NULL").select(FILE, "stage", "reason"))


def _with_columns(result: CleanResult, scan: Scan) -> DataFrame:
    return result.files.join(scan.files.select(FILE, "columns"), FILE)


def _clean(spark, scan: Scan, options: JobOptions, workspace: Workspace) -> CleanResult:
    names = scan.files.where("reason IS NULL").select(FILE)
    result = clean(scan.rows, names, options.dayfirst, workspace=workspace)
    if not options.flag_skipped:
        return result
    log = quality_log(result.files, flag_skipped=True)
    return replace(result, quality_log=log)


def _report(table, result, rows, options: JobOptions, workspace: Workspace) -> JobResult:
    with _Stage("export"):
        report = start_report(table, rows, options.report, workspace)
        # The cleaning is final now; its log survives a failure of a later member.
        log_table.append(result.quality_log, options.log)
    with _Stage("analysis"):
        print(config.EXCLUDED.format(rows=report.totals["excluded_rows"]))
        print(config.ANALYSING)
        if options.preview:
            _say_previews(analyse(report.table, report.rows, workspace))
    with _Stage("export"):
        print(config.EXPORTING)
        finish_report(report, result.quality_log, options.report, workspace)
        print(config.SAVED.format(path=report.path))
    good = result.files.filter(F.col("stage").isNull())
    last = good.agg(F.max_by("run_id", FILE)).first()[0]
    return JobResult(report.path, last, rows)


def _say_counts(facts) -> None:
    rows_in, kept = facts["rows_in"], facts["rows_kept"]
    print(config.LOADED.format(rows=rows_in, columns=facts["columns"]))
    if facts["dates_not_strict"]:
        print(config.DATES_INFERRED)
    if facts["stage"] is None:
        print(config.CLEANED.format(rows=rows_in, kept=kept, dropped=rows_in - kept))


def _say_skipped(rejected: dict) -> None:
    for name, reason in sorted(rejected.items()):
        print(config.PROCESSING.format(name=name))
        print(config.SKIPPED.format(name=name, reason=reason))


def _say_previews(results: dict) -> None:
    for name, table in results.items():
        order = PREVIEW_ORDER[name]
        shown = sheets.preview(table, *order) if order else table.limit(5)
        print(f"\n--- {name} ({table.count()} rows) ---")
        shown.show(5, truncate=False)


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="anemoscope")
    parser.add_argument("--file", help="one SCADA CSV source")
    parser.add_argument("--folder", help="a folder of SCADA CSV sources")
    parser.add_argument("--output", default="output", help="folder for reports")
    parser.add_argument("--log", default=JobOptions.log, help="audit log table")
    parser.add_argument("--format", default="parquet", choices=bundle.FORMATS)
    parser.add_argument("--dayfirst", action="store_true", help="read 02 01 as 2 January")
    parser.add_argument("--sort", action="store_true", help="sort the row-level members")
    parser.add_argument("--preview", action="store_true", help="show five rows per result")
    parser.add_argument("--flag-skipped", action="store_true", help="log skipped files")
    chosen = parser.parse_args(arguments)
    if chosen.file and chosen.folder:
        raise ReportError(config.BOTH_INPUTS, "arguments")
    if not chosen.file and not chosen.folder:
        raise ReportError(config.NO_INPUT, "arguments")
    return chosen


def main(arguments: list[str] | None = None) -> None:
    """Run from arguments; every failure ends in one plain message."""
    try:
        chosen = parse_arguments(arguments)
        spark = (
            SparkSession.builder.appName("anemoscope")
            .config("spark.sql.session.timeZone", "UTC")
            .getOrCreate()
        )
        storage.set_partitions(spark, chosen.file or chosen.folder)
        options = JobOptions(
            ReportOptions(chosen.output, chosen.format, chosen.sort),
            chosen.log, chosen.dayfirst, chosen.preview, chosen.flag_skipped,
        )
        if chosen.file:
            run_single(spark, chosen.file, options)
        else:
            run_batch(spark, chosen.folder, options)
    except ReportError as error:
        sys.exit(error.message)
