"""Per-file cleaning: duplicates, numbers, missing values, dates, audit rows.

Everything is decided per source file, yet no file is handled on its own: each
decision is one aggregate keyed by ``source_file`` whose small result is looked
up by the rows. Scans of the data: profile the raw text, deduplicate (the only
shuffle of whole rows), profile the typed rows, fill.
"""

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.dates import (
    in_numbers, in_range, is_padded, is_strict, iso_text, meridiem, on_twelve_hours, rarely,
    with_whole_clock,
)
from anemoscope.functions.numbers import integer, number
from anemoscope.functions.text import col
from anemoscope.operators.lookup import attach
from anemoscope.operators.quantiles import exact_quantiles
from anemoscope.sources.csv_scan import TOO_LONG
from anemoscope.sources.storage import Workspace

FILE = config.SOURCE_FILE
ROWS_IN = "rows_in"
DATE_FORMAT = "date_format"  # 'strict', 'flexible' or 'failed'; NULL without text


def extra_columns(table: DataFrame) -> list[str]:
    """Input columns beyond the five known ones."""
    known = {FILE, TOO_LONG, DATE_FORMAT, *config.COLUMNS.values()}
    known |= {f"{metric}_invalid" for metric in config.METRICS}
    return [name for name in table.columns if name not in known]


# --- Numbers -------------------------------------------------------------------


def coerce_numeric(raw: DataFrame) -> DataFrame:
    """The four metrics as DOUBLE, each with a flag for text that is no number."""
    numbers = {f"__{m}": number(col(m).cast("string")) for m in config.METRICS}
    typed = {}
    for metric in config.METRICS:
        value = col(f"__{metric}")
        typed[f"{metric}_invalid"] = col(metric).isNotNull() & value.isNull()
        typed[metric] = value
    return raw.withColumns(numbers).withColumns(typed).drop(*numbers)


def coercion_counts(typed: DataFrame) -> DataFrame:
    """Per file and metric: values that coercion turned into NULL."""
    counts = typed.groupBy(FILE).agg(
        *[F.count_if(f"{metric}_invalid").alias(metric) for metric in config.METRICS]
    )
    return counts.unpivot(FILE, config.METRICS, "column", "row_count")


# --- Duplicates -----------------------------------------------------------------


def raw_profile(raw: DataFrame) -> DataFrame:
    """Per file: rows, over-long rows, and which columns hold only numbers.

    Duplicates compare values after type inference, so '1.0' equals '1.00' in a
    column of numbers and differs in a column that also holds other text. A metric
    without missing values whose numbers are all written as 64-bit integers is
    compared as such, any other as DOUBLE.
    """
    facts = [F.count(F.lit(1)).alias(ROWS_IN)]
    if TOO_LONG in raw.columns:
        facts.append(F.count_if(TOO_LONG).alias("long_rows"))
    else:
        facts.append(F.lit(0).cast("bigint").alias("long_rows"))
    for metric in config.METRICS:
        text = col(metric).cast("string")
        facts += [
            _none(text.isNotNull() & number(text).isNull(), f"{metric}_text"),
            _none(_as_integer(text).isNull(), f"__{metric}_whole", True),
        ]
    for i, name in enumerate(extra_columns(raw)):
        text = col(name).cast("string")
        facts += [
            _none(text.isNotNull() & integer(text).isNull(), f"__whole{i}", True),
            _none(text.isNotNull() & number(text).isNull(), f"__number{i}", True),
            _none(~text.isin(config.BOOLEANS), f"__boolean{i}", True),
        ]
    return raw.groupBy(FILE).agg(*facts)


def _as_integer(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def _none(condition: Column, name: str, wanted: bool = False) -> Column:
    found = F.coalesce(F.bool_or(condition), F.lit(False))
    return (~found if wanted else found).alias(name)


def deduplicate(
    raw: DataFrame, profile: DataFrame, files: int | None = None
) -> DataFrame:
    """One row per distinct row of each loadable file, metrics typed.

    The grouping key is the whole row, so copies collapse before the shuffle
    and no key is hot. ``date_time`` stays text here.
    """
    extras = extra_columns(raw)
    files = profile.count() if files is None else files
    texts = [col(c).cast("string").alias(c) for c in [*config.COLUMNS.values(), *extras]]
    rows = raw.select(FILE, *texts)
    if files > config.BROADCAST_ROWS:
        rows = rows.distinct()  # copies must not meet in one salted join task
    loadable = profile.filter(F.col("long_rows") == 0).drop("long_rows")
    rows = attach(rows, loadable, [FILE], "inner", files, ROWS_IN)
    keys = [F.col(FILE), F.col("date_time")]
    for metric in config.METRICS:
        is_text, whole = F.col(f"{metric}_text"), F.col(f"__{metric}_whole")
        keys += [
            F.when(~is_text & ~whole, number(col(metric))).alias(metric),
            F.when(whole, _as_integer(col(metric))).alias(f"__{metric}_value"),
            F.when(is_text, col(metric)).alias(f"{metric}_text"),
        ]
    keys += [_canonical(col(name), i).alias(name) for i, name in enumerate(extras)]
    distinct = rows.select(*keys).distinct()
    values = {
        m: F.coalesce(m, F.col(f"__{m}_value").cast("double"), number(col(f"{m}_text")))
        for m in config.METRICS
    }
    invalid = {
        f"{m}_invalid": F.col(f"{m}_text").isNotNull() & F.col(m).isNull()
        for m in config.METRICS
    }
    typed = distinct.withColumns(values).withColumns(invalid)
    return typed.drop(*[name for m in config.METRICS for name in (f"{m}_text", f"__{m}_value")])


def _canonical(text: Column, i: int) -> Column:
    """One spelling per value of an extra column, by the kind of the column."""
    return (
        F.when(F.col(f"__whole{i}"), integer(text).cast("string"))
        .when(F.col(f"__number{i}"), (number(text) + F.lit(0.0)).cast("string"))
        .when(F.col(f"__boolean{i}"), F.initcap(text))
        .otherwise(text)
    )


def duplicate_count(profile: DataFrame, distinct: DataFrame) -> DataFrame:
    """Per file: rows before, rows after, and the duplicates between them."""
    after = distinct.groupBy(FILE).agg(F.count(F.lit(1)).alias("rows_distinct"))
    return (
        profile.select(FILE, ROWS_IN)
        .join(after, FILE)
        .withColumn("row_count", F.col(ROWS_IN) - F.col("rows_distinct"))
    )


# --- Dates ----------------------------------------------------------------------


def parse_dates(table: DataFrame, dayfirst: bool = False) -> DataFrame:
    """``date_time`` as TIMESTAMP_NTZ, and how each value was understood.

    A file with any value outside the strict format counts as inferred. Values
    in the strict format mean the same either way, so rows are parsed alone.
    """
    text, padded, strict = F.col("__text"), F.col("__padded"), F.col("__strict")
    moment, half = F.col("__moment"), F.col("__half")
    # One column per step: a single expression would outgrow what the JIT compiles. Only what
    # is in no form of numbers goes through the forms with names and short years.
    other = text.isNotNull() & F.col("__written").isNull()
    stepwise = (
        table.withColumn("__text", F.col("date_time").cast("string"))
        .withColumn("__padded", is_padded(text))
        .withColumn("__strict", padded | is_strict(text))
        .withColumn("__written", F.when(padded, text).otherwise(iso_text(text, dayfirst)))
        .withColumn("__plain", F.when(other, in_numbers(text)))
        .withColumn("__half", F.when(other, meridiem(text)))
        .withColumn("__later", F.when(other, rarely(F.col("__plain"), lambda t: iso_text(t, dayfirst))))
        .withColumn("__found", F.coalesce("__written", "__later"))
        .withColumn("__iso", F.when(padded, text).otherwise(with_whole_clock(F.col("__found"))))
        .withColumn("__moment", in_range(F.col("__iso").try_cast("timestamp_ntz")))
        .withColumn("date_time", F.when(half.isNull(), moment).otherwise(on_twelve_hours(moment, half)))
    )
    understood = (
        F.when(text.isNull(), None)
        .when(F.col("date_time").isNull(), "failed")
        .when(strict, "strict")
        .otherwise("flexible")
    )
    parsed = stepwise.withColumn(DATE_FORMAT, understood)
    return parsed.drop(
        "__text", "__padded", "__strict", "__written", "__plain", "__half", "__later", "__found",
        "__iso", "__moment",
    )


# --- Missing values --------------------------------------------------------------


def drop_critical(table: DataFrame) -> DataFrame:
    """Rows that have both a date and an active power."""
    return table.filter(_has_date(table) & F.col("active_power").isNotNull())


def _has_date(table: DataFrame) -> Column:
    parsed = DATE_FORMAT in table.columns
    return F.col(DATE_FORMAT if parsed else "date_time").isNotNull()


def null_facts(table: DataFrame) -> list[Column]:
    """Aggregates that count nulls in the order in which rows are dropped."""
    dated = _has_date(table)
    kept = dated & F.col("active_power").isNotNull()
    return [
        F.count_if(~dated).alias("date_time"),
        F.count_if(dated & F.col("active_power").isNull()).alias("active_power"),
        *[
            F.count_if(kept & F.col(metric).isNull()).alias(metric)
            for metric in config.MEDIAN_FILLED
        ],
    ]


def null_counts(table: DataFrame) -> DataFrame:
    """Per file and column: nulls that drop a row or are filled."""
    columns = ["date_time", "active_power", *config.MEDIAN_FILLED]
    counts = table.groupBy(FILE).agg(*null_facts(table))
    return counts.unpivot(FILE, columns, "column", "row_count")


def file_medians(
    kept: DataFrame,
    largest_file: int | None = None,
    files: int | None = None,
    workspace: Workspace | None = None,
    buffer_rows: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Per file: exact medians of the filled columns over the kept rows."""
    columns = columns or config.MEDIAN_FILLED
    medians = exact_quantiles(
        kept, [FILE], columns, [0.5], largest_file, files, workspace, buffer_rows
    )
    return medians.select(FILE, *[F.col(m)[0].alias(f"{m}_median") for m in columns])


def fill_medians(
    kept: DataFrame, medians: DataFrame, files: int | None = None, weight: str | None = None
) -> DataFrame:
    """Nulls replaced by the file's median; all-null columns stay null."""
    columns = [m for m in config.MEDIAN_FILLED if f"{m}_median" in medians.columns]
    filled = attach(kept, medians, [FILE], "left", files, weight).withColumns(
        {m: F.coalesce(m, f"{m}_median") for m in columns}
    )
    return filled.drop(*[f"{m}_median" for m in columns])


# --- The whole cleaning run --------------------------------------------------------


@dataclass(frozen=True)
class Run:
    """Identity of one cleaning job; every file gets its own run id from it."""

    seed: str
    timestamp: str

    @staticmethod
    def start() -> "Run":
        return Run(str(uuid.uuid4()), datetime.now(timezone.utc).isoformat())

    def run_id(self, file: Column) -> Column:
        """A version-4 shaped UUID per file, the same on every evaluation."""
        digest = F.md5(F.concat(F.lit(self.seed), file))
        variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
        return F.concat_ws(
            "-",
            F.substring(digest, 1, 8),
            F.substring(digest, 9, 4),
            F.concat(F.lit("4"), F.substring(digest, 14, 3)),
            F.concat(variant, F.substring(digest, 18, 3)),
            F.substring(digest, 21, 12),
        )


@dataclass(frozen=True)
class CleanResult:
    """Clean rows of the valid files, and one row of facts per file.

    Medians are only looked for when the rows are asked for.
    """

    rows: Callable[[], DataFrame]
    files: DataFrame
    quality_log: DataFrame

    @cached_property
    def table(self) -> DataFrame:
        return self.rows()


def typed_profile(typed: DataFrame) -> DataFrame:
    """Per file: every count the audit log and the validity check need."""
    kept = _has_date(typed) & F.col("active_power").isNotNull()
    facts = [F.count(F.lit(1)).alias("rows_distinct"), F.count_if(kept).alias("rows_kept")]
    facts += [
        F.count_if(f"{metric}_invalid").alias(f"coerced_{metric}")
        for metric in config.METRICS
    ]
    nulls = null_facts(typed)
    names = ["date_time", "active_power", *config.MEDIAN_FILLED]
    facts += [count.alias(f"null_{name}") for name, count in zip(names, nulls)]
    facts += [
        F.count_if(kept & (F.col(DATE_FORMAT) != "strict")).alias("dates_not_strict"),
        F.count_if(kept & (F.col(DATE_FORMAT) == "failed")).alias("dates_failed"),
    ]
    return typed.groupBy(FILE).agg(*facts)


def file_facts(
    raw_facts: DataFrame, typed_facts: DataFrame, run: Run, names: DataFrame | None = None
) -> DataFrame:
    """One row per file: counts, run id, and the reason if it is skipped.

    ``names`` adds files without any data row, whose counts are all zero.
    """
    facts = raw_facts.select(FILE, ROWS_IN, "long_rows").join(typed_facts, FILE, "left")
    if names is not None:
        facts = names.join(facts, FILE, "left")
    counts = [name for name in facts.columns if name != FILE]
    facts = facts.fillna(0, counts)
    long_row = F.replace(
        F.lit(config.UNREADABLE_FILE.replace("{reason}", "a row has more fields than the header")),
        F.lit("{path}"), F.col(FILE),
    )
    dates = F.replace(
        F.lit(config.DATE_FAILED),
        F.lit("{reason}"),
        F.format_string("%d value(s) match no supported date format", "dates_failed"),
    )
    too_long, failed = F.col("long_rows") > 0, F.col("dates_failed") > 0
    return facts.withColumns(
        {
            "run_id": run.run_id(F.col(FILE)),
            "run_timestamp": F.lit(run.timestamp),
            "stage": F.when(too_long, "load").when(failed, "clean"),
            "reason": F.when(too_long, long_row).when(failed, dates),
            "rows_out": F.when(~too_long & ~failed, F.col("rows_kept")),
        }
    )


def quality_log(files: DataFrame, flag_skipped: bool = False) -> DataFrame:
    """Audit rows: eleven per cleaned file, in the order of the cleaning steps.

    A file that fails at its dates has already logged the ten steps before; a
    file that fails to load has none. ``flag_skipped`` adds one entry per
    skipped file.
    """
    raw = config.RAW_HEADERS
    entries = [_entry("row", "duplicate", F.col(ROWS_IN) - F.col("rows_distinct"), "dropped")]
    entries += [
        _entry(raw[m], "type_coercion", F.col(f"coerced_{m}"), "coerced")
        for m in config.METRICS
    ]
    entries += [
        _entry(raw[c], "null", F.col(f"null_{c}"), "dropped")
        for c in ("date_time", "active_power")
    ]
    entries += [
        _entry(raw[m], "null", F.col(f"null_{m}"), "filled_median")
        for m in config.MEDIAN_FILLED
    ]
    inferred = F.when(F.col("dates_not_strict") > 0, "date_parse_failure")
    cleaned = F.col("stage").isNull()
    dates = _entry(
        config.RAW_DATE_TIME, F.coalesce(inferred, F.lit("type_coercion")), F.lit(0), "coerced"
    )
    loaded = F.coalesce(F.col("stage") != "load", F.lit(True))
    logged = [F.when(loaded, entry) for entry in entries] + [F.when(cleaned, dates)]
    if flag_skipped:
        issue = F.when(F.col("stage") == "clean", "date_parse_failure").otherwise("type_coercion")
        flag = _entry("row", issue, F.col(ROWS_IN), "flagged")
        logged.append(F.when(~cleaned, flag))
    steps = F.posexplode(F.array(*logged)).alias("step", "entry")
    return (
        files.select(FILE, "run_id", "run_timestamp", steps)
        .filter(F.col("entry").isNotNull())
        .select(FILE, "step", "run_id", "run_timestamp", "entry.*")
    )


def _entry(column: str, issue, count: Column, action: str) -> Column:
    issue = F.lit(issue) if isinstance(issue, str) else issue
    return F.struct(
        F.lit(column).alias("column"),
        issue.alias("issue_type"),
        count.cast("bigint").alias("row_count"),
        F.lit(action).alias("action_taken"),
    )


def clean(
    raw: DataFrame,
    names: DataFrame | None = None,
    dayfirst: bool = False,
    run: Run | None = None,
    workspace: Workspace | None = None,
) -> CleanResult:
    """Clean every file of a raw table, each by its own values."""
    run = run or Run.start()
    workspace = workspace or Workspace(raw.sparkSession)
    raw_facts = workspace.stage(raw_profile(raw), "raw-profile")
    distinct = deduplicate(raw, raw_facts, raw_facts.count())
    typed = workspace.stage(parse_dates(distinct, dayfirst), "typed")
    typed_facts = typed_profile(typed)
    files = workspace.stage(file_facts(raw_facts, typed_facts, run, names), "files")
    return CleanResult(
        lambda: _clean_rows(typed, files, workspace), files, quality_log(files)
    )


def _clean_rows(typed: DataFrame, files: DataFrame, workspace: Workspace) -> DataFrame:
    """Kept rows of the valid files with medians filled where any are missing."""
    columns = [FILE, *config.COLUMNS.values(), *extra_columns(typed)]
    kept = drop_critical(typed).select(*[col(name) for name in columns])
    to_fill = reduce(lambda a, b: a + b, [F.col(f"null_{m}") for m in config.MEDIAN_FILLED])
    valid = F.col("stage").isNull()
    holed = valid & (to_fill > 0)
    summary = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.max(F.when(holed, F.col("rows_kept"))).alias("largest"),
        F.count_if(~valid).alias("skipped"),
        F.count_if(holed).alias("holed"),
        *[F.sum(F.when(valid, F.col(f"null_{m}"))).alias(m) for m in config.MEDIAN_FILLED],
    ).first()
    if summary["skipped"]:
        names = files.filter(valid).select(FILE, "rows_kept")
        kept = attach(kept, names, [FILE], "left_semi", summary["files"], "rows_kept")
    if summary["holed"]:
        names = files.filter(holed).select(FILE, "rows_kept")
        rows = attach(kept, names, [FILE], "left_semi", summary["holed"], "rows_kept")
        columns = [m for m in config.MEDIAN_FILLED if summary[m]]
        medians = file_medians(
            rows, summary["largest"], summary["holed"], workspace, columns=columns
        )
        medians = workspace.stage(medians, "medians")
        kept = fill_medians(kept, medians.join(names, FILE), summary["holed"], "rows_kept")
    return kept
