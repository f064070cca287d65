"""The report: a dated folder with one dataset per member, never overwritten."""

from datetime import date
from itertools import count

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from anemoscope.errors import ReportError
from anemoscope.sources import storage

FORMATS = ("parquet", "csv")


def check_output(spark: SparkSession, inputs: list[str], output: str, log: str | None = None) -> None:
    """Refuse to write onto, or inside, anything that is read, or log into a report."""
    pairs = [(place, path, "input") for place in (output, log) if place for path in inputs]
    if log:
        # Reports are folders of their own in the output folder; the log may stand beside them.
        pairs.append((log, f"{output}/report_", "report"))
        if storage.qualified(spark, log) == storage.qualified(spark, output):
            raise ReportError(f"Error: The log path {log} is the output path", "export")
    for place, path, kind in pairs:
        target, source = storage.qualified(spark, place), storage.qualified(spark, path)
        inside = target.startswith(source if kind == "report" else source + "/")
        if target == source or inside:
            raise ReportError(
                f"Error: The output path {place} lies inside the {kind} {path}", "export"
            )


def write_dataset(table: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = table.write.mode("errorifexists").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def claim(
    output: str, first_member: str, table: DataFrame, fmt: str, day: date
) -> str:
    """Write the first member into the first free folder name of the day.

    The write itself fails on an existing path, so a name taken meanwhile by
    another run moves this run on to the next suffix.
    """
    spark = table.sparkSession
    for number in count():
        suffix = f"_{number}" if number else ""
        folder = f"{output}/report_{day.isoformat()}{suffix}"
        if storage.exists(spark, folder):
            continue
        try:
            write_dataset(table, f"{folder}/{first_member}", fmt)
            return folder
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
