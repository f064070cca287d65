"""SCADA CSV files as one all-string DataFrame that knows each row's file.

A source is one ``*.csv`` path: a plain file, or a folder of part files as Spark writes them.
Files and their headers make a table, read by Spark tasks if they are many. All files are then
read by one scan of lines, whatever their headers: a line is cut into fields by position, and
a look-up in the table of files says which field is which column. The rows are staged, so
that sources are read once.

Every row carries what decides whether its file was read well: the bytes of its line, whether
they are UTF-8 and whether the line ends inside a quoted field. A summary per file finds files
that broke off, hold other bytes, or whose records go over several lines; only the last are
read again, by ``records``.
"""

import csv
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.errors import ReportError
from anemoscope.functions.text import col, na_to_null
from anemoscope.operators.lookup import attach
from anemoscope.sources import records, storage
from anemoscope.sources.storage import Workspace

FILE = config.SOURCE_FILE
TOO_LONG = "row_too_long"
PATH, SIZE, KIND = "__path", "__size", "__kind"
DATA, HEADER, BLANK = 0, 1, 2
#: The headers of so many files are read before tasks for them could start.
FEW_FILES = 32
#: The same for the part files of that few sources: a task for a large file costs the start of
#: a Python worker, and parts grow in number with the sources' size.
FEW_PARTS = 512
#: Files up to this size share tasks when headers are read; of a larger one the task that
#: has it alone reads the first lines and stops.
SMALL_FILE = 64 * 1024
#: Paths that are named in a filter; more are looked up in the table of files.
NAMED_PATHS = 1_000
#: A byte order mark is not part of any line.
MARK_BYTES = 3
_HEADERS = pa.schema([
    (PATH, pa.string()), ("header", pa.list_(pa.string())), ("text", pa.string()),
    ("names", pa.list_(pa.string())), ("missing", pa.list_(pa.string())), ("problem", pa.string()),
])
_HEADERS_DDL = (
    f"{PATH} string, header array<string>, text string, names array<string>,"
    " missing array<string>, problem string"
)


@dataclass(frozen=True)
class Sources:
    """CSV sources by a path pattern. Which files it stands for is found by Spark."""

    pattern: str
    base: str  # the folder of the sources, as Spark writes paths
    count: int
    folder: str | None = None  # where there are no folders inside, it is listed at once

    def read(self, reader):
        """What a reader finds in the files."""
        if self.folder is None:
            return reader.load(self.pattern)
        return reader.option("pathGlobFilter", "*.csv").load(self.folder)


@dataclass(frozen=True)
class Scan:
    """Rows of all loadable sources, and one row of facts per source."""

    rows: DataFrame | None
    files: DataFrame  # source file, columns, missing columns, and the reason if not loadable

    @cached_property
    def columns(self) -> dict:
        """Number of columns of the loadable sources."""
        found = self.files.where("reason IS NULL").select(FILE, "columns").collect()
        return {row[FILE]: row["columns"] for row in found}

    @cached_property
    def rejected(self) -> dict:
        """The reasons of the sources that cannot be loaded."""
        found = self.files.where("reason IS NOT NULL").select(FILE, "reason").collect()
        return {row[FILE]: row["reason"] for row in found}


# --- Listing --------------------------------------------------------------------------


def list_sources(spark: SparkSession, folder: str) -> Sources:
    """The ``*.csv`` entries directly inside a folder."""
    if not storage.exists(spark, folder):
        raise ReportError(config.FOLDER_NOT_FOUND.format(path=folder), "load")
    literal = _literal_path(folder.rstrip("/"))
    found = _entries(spark, f"{literal}/*.csv")
    if not len(found):
        raise ReportError(config.NO_CSV_FILES.format(path=folder), "load")
    flat = not len(_entries(spark, f"{literal}/*/*"))
    return Sources(f"{literal}/*.csv", _encoded(spark, folder), len(found), literal if flat else None)


def list_source(spark: SparkSession, path: str) -> Sources:
    """A single source."""
    if not storage.exists(spark, path):
        raise ReportError(config.FILE_NOT_FOUND.format(path=path), "load")
    parent = storage.hadoop_path(spark, storage.qualified(spark, path)).getParent().toString()
    return Sources(_literal_path(path.rstrip("/")), _encoded(spark, parent), 1)


def _entries(spark: SparkSession, pattern: str):
    return storage.file_system(spark, pattern).globStatus(storage.hadoop_path(spark, pattern))


def inputs_holding(spark: SparkSession, folder: str, places: list[str]) -> list[str]:
    """The sources of a folder in which one of some other paths would lie."""
    base, found = storage.qualified(spark, folder) + "/", []
    for place in places:
        inside = storage.qualified(spark, place)
        source = base + inside.removeprefix(base).split("/")[0]
        if inside.startswith(base) and source.endswith(".csv") and storage.exists(spark, source):
            found.append(source)
    return found


def _encoded(spark: SparkSession, path: str) -> str:
    return _uri(storage.hadoop_path(spark, storage.qualified(spark, path))).rstrip("/")


def _uri(path) -> str:
    """A path as ``_paths`` has it; without a host it is written with one or three slashes."""
    return re.sub(r"^(\w+):///", r"\1:/", path.toUri().toString())


def _paths(name: str = "_metadata.file_path") -> Column:
    return F.regexp_replace(name, r"^(\w+):///", "$1:/").alias(PATH)


def _literal_path(path: str) -> str:
    """A path whose special characters are not taken for a glob pattern."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def _source_name(base: str) -> Column:
    """The name of a file in the sources' folder, or of the folder a part file lies in."""
    folder = F.regexp_replace(PATH, "/[^/]*$", "")
    name = F.substring_index(F.when(folder == base, F.col(PATH)).otherwise(folder), "/", -1)
    # Freed of URL escapes if it has any; a plus sign is none.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


# --- Headers ---------------------------------------------------------------------------

#: The raw headers that stand for a known column.
_KNOWN = config.COLUMNS | {
    config.RAW_WIND_DIRECTION_ALIAS: config.COLUMNS[config.RAW_WIND_DIRECTION]
}
_TAKEN = sorted(
    {*config.COLUMNS.values(), config.SOURCE_FILE, TOO_LONG, "date_format", *config.OWN_COLUMNS}
    | {f"{m}_{kind}" for m in config.METRICS for kind in ("invalid", "text", "median")}
)


def missing_columns(header: tuple) -> list[str]:
    """Required raw columns a header lacks, in their documented order."""
    present = {_KNOWN.get(name) for name in header}
    return [raw for raw, name in config.COLUMNS.items() if name not in present]


def schema_message(header: tuple) -> str | None:
    """Why a header fails validation, or None if it passes."""
    missing = missing_columns(header)
    if not missing:
        return None
    return config.SCHEMA_FAILED.format(missing=missing, expected=list(config.COLUMNS))


def column_names(header: tuple) -> list[str]:
    """Unique names: the five known columns renamed, repeats numbered.

    An extra column that would hide one of the package's own names, begins like its
    helper columns, or repeats an earlier column, gets a numbered suffix.
    """
    names, taken = [], set(_TAKEN)
    for position, raw in enumerate(header):
        name = _KNOWN.get(raw)
        if name and name not in names:
            names.append(name)
            continue
        name = raw or f"Unnamed: {position}"
        unique, repeat = name, 0
        while unique.lower() in taken or (not repeat and unique.startswith("__")):
            repeat += 1
            unique = f"{name}.{repeat}"
        taken.add(unique.lower())
        names.append(unique)
    return names


def first_record(lines: Iterator[str]) -> tuple[list[str], str]:
    """The fields and the text of the first record that is not blank; empty if there is none."""
    used = []

    def record():
        for line in lines:
            line = line.rstrip("\r")
            if used or line.strip("\ufeff \t"):
                used.append(line if used else line.lstrip("\ufeff"))
                yield used[-1] + "\n"

    return next(csv.reader(record()), []), "\n".join(used)


def _described(path: str, lines: Iterator[str]) -> tuple:
    """A row of the table of files, but for source and size."""
    try:
        header, text = first_record(lines)
    except csv.Error as error:
        return path, None, None, None, None, str(error)
    if not header:
        return path, None, None, None, None, ""
    return path, header, text, column_names(header), missing_columns(header), schema_message(header)


def _headers_of(alone: bool):
    """Headers of the files whose lines come by; ``alone`` stops after the first."""

    def run(batches):
        pairs = (
            pair
            for batch in batches
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        )
        for path, lines in groupby(pairs, key=lambda pair: pair[0]):
            row = _described(path, (line.decode("utf-8", "replace") for _, line in lines))
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], f.type) for value, f in zip(row, _HEADERS)], schema=_HEADERS
            )
            if alone:
                return

    return run


def _read_headers(spark: SparkSession, sources: Sources) -> DataFrame:
    """Path and header of every file that has lines, read by tasks in sessions of their own.

    There a file is never cut, and files open at such a cost that large ones lie alone in
    their task, which ends after the first record.
    """
    most = 1 << 36

    def headers(wanted: Column, cost: int, alone: bool) -> DataFrame:
        own = spark.newSession()
        own.conf.set("spark.sql.files.maxPartitionBytes", most)
        own.conf.set("spark.sql.files.openCostInBytes", cost)
        own.conf.set("spark.sql.files.minPartitionNum", 1 if alone else 64)
        own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64 if alone else 1_000)
        lines = _lines(own, sources).where(wanted)
        return lines.select(PATH, F.col("value").cast("binary")).mapInArrow(
            _headers_of(alone), _HEADERS_DDL
        )

    size = F.col("_metadata.file_size")
    small = headers(size <= SMALL_FILE, SMALL_FILE, False)
    return small.unionByName(headers(size > SMALL_FILE, most, True))


def _few_files(spark: SparkSession, sources: Sources) -> list | None:
    """Statuses of the files, if they are few, or parts of few sources."""
    if sources.count > FEW_FILES:
        return None
    found, most = [], max(FEW_FILES, FEW_PARTS)
    for entry in _entries(spark, sources.pattern):
        inner = [entry]
        if entry.isDirectory():
            fs = storage.file_system(spark, sources.pattern)
            inner = [status for status in fs.listStatus(entry.getPath()) if status.isFile()]
        found += [status for status in inner if not status.getPath().getName().startswith(("_", "."))]
        if len(found) > most:
            return None
    return [status for status in found if status.getLen()]


def _lines_of(spark: SparkSession, path) -> Iterator[str]:
    """The lines of one file, read by the driver."""
    jvm = spark._jvm
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            yield line
    finally:
        reader.close()


def _described_here(spark: SparkSession, status) -> tuple:
    path = status.getPath()
    encoded = _uri(path)
    try:
        row = _described(encoded, _lines_of(spark, path))
    except Py4JJavaError as error:
        row = (encoded, None, None, None, None, _java_reason(error))
    return *row, status.getLen()


def _counts() -> list[Column]:
    bad = F.count_if(F.col("problem").isNotNull()).alias("bad")
    return [F.count(F.lit(1)).alias("files"), bad]


def _few_described(spark: SparkSession, sources: Sources, found: list):
    """The table of a few files, with its counts and all names of columns."""
    rows = []
    for status in found:
        row = _described_here(spark, status)
        folder, name = row[0].rsplit("/", 1)
        source = name if folder == sources.base else folder.rsplit("/", 1)[-1]
        rows.append((*row, unquote(source)))
    schema = pa.schema([*_HEADERS, (SIZE, pa.int64()), (FILE, pa.string())])
    columns = [pa.array([row[n] for row in rows], f.type) for n, f in enumerate(schema)]
    bad = {row[-1] for row in rows if row[5] is not None}
    extras = {}
    for row in sorted(rows, key=lambda row: (row[-1], row[0])):
        for name in row[3] or () if row[-1] not in bad else ():
            extras.setdefault(name.lower(), name)
    seen = {
        "files": len(rows), "bad": sum(row[5] is not None for row in rows),
        "sources": len({row[-1] for row in rows}), "names": _known_first(extras.values()),
    }
    return spark.createDataFrame(pa.table(columns, schema=schema)), seen


def _many_described(spark: SparkSession, sources: Sources, workspace: Workspace):
    """The same for any number of files; their names are looked up later."""
    listed = (
        sources.read(spark.read.format("binaryFile"))
        .select(_paths(), F.col("length").alias(SIZE))
    )
    files = listed.join(_read_headers(spark, sources), PATH, "left")
    problem = F.coalesce("problem", F.when(F.col("header").isNull(), F.lit("")))
    named = files.withColumns({FILE: _source_name(sources.base), "problem": problem})
    files = workspace.stage(named, "files")
    return files, files.agg(*_counts(), F.count_distinct(FILE).alias("sources")).first().asDict()


def _table_of_files(spark: SparkSession, sources: Sources, workspace: Workspace):
    """One row per file: its source, size and header, and why it cannot be loaded.

    Also how many files and sources there are, and how many with a problem.
    """
    few = _few_files(spark, sources)
    if few is None:
        files, seen = _many_described(spark, sources, workspace)
    else:
        files, seen = _few_described(spark, sources, few)
    if seen["sources"] < sources.count:
        files = files.unionByName(_without_files(spark, sources, files), allowMissingColumns=True)
    elif not seen["bad"]:
        return files, seen
    # Only of files without a header the driver asks why.
    silent = files.where("problem IS NOT NULL AND header IS NULL")
    asked = [
        (row[PATH], _unreadable(row[PATH], row["problem"] or _reason(spark, row[PATH])))
        for row in silent.select(PATH, "problem").toLocalIterator()
    ]
    reasons = spark.createDataFrame(asked, f"{PATH} string, reason string")
    files = files.join(reasons, PATH, "left").withColumn("problem", F.coalesce("reason", "problem"))
    files = workspace.stage(files.drop("reason"), "files-with-reasons")
    return files, seen | files.agg(*_counts()).first().asDict()


def _without_files(spark: SparkSession, sources: Sources, files: DataFrame) -> DataFrame:
    """Sources of which no file was listed: empty files and folders."""
    names = []
    for status in _entries(spark, sources.pattern):
        path = status.getPath()
        if path.getName().startswith(("_", ".")):
            continue  # hidden
        reason = "The folder has no files" if status.isDirectory() else ""
        names.append((path.getName(), _uri(path), 0, reason))
    entries = spark.createDataFrame(names, f"{FILE} string, {PATH} string, {SIZE} bigint, problem string")
    return entries.join(files.select(FILE).distinct(), FILE, "left_anti")


def _unreadable(path: str, reason: str) -> str:
    return config.UNREADABLE_FILE.format(path=unquote(path), reason=reason)


def _java_reason(error: Py4JJavaError) -> str:
    cause = error.java_exception
    return f"{cause.getClass().getSimpleName()}: {cause.getMessage()}"


def _reason(spark: SparkSession, path: str) -> str:
    """Why a file has no header."""
    try:
        next(_lines_of(spark, storage.hadoop_path(spark, unquote(path))), None)
    except Py4JJavaError as error:
        return _java_reason(error)
    return "No columns to parse from file"


# --- Rows --------------------------------------------------------------------------------


def _known_first(names) -> list[str]:
    known = list(config.COLUMNS.values())
    return known + [name for name in names if name not in known]


def _all_names(files: DataFrame) -> list[str]:
    """Every column of any file: the known ones, then extras as they first appear."""
    named = files.select(FILE, PATH, F.posexplode("names").alias("position", "name"))
    first = F.struct(FILE, PATH, "position")
    found = named.groupBy(F.lower("name").alias("key")).agg(
        F.min(first).alias("first"), F.min_by("name", first).alias("name")
    )
    return _known_first(row["name"] for row in sorted(found.collect(), key=lambda row: row["first"]))


def _lines(spark: SparkSession, sources: Sources, **options) -> DataFrame:
    """Lines with their file. A block that cannot be read ends its file without an error."""
    reader = spark.read.options(ignoreCorruptFiles=True, ignoreMissingFiles=True, **options)
    return sources.read(reader.format("text")).select("value", "_metadata").withColumns(
        {PATH: _paths(), "__block": F.col("_metadata.file_block_start")}
    )


def _plain_lines(spark: SparkSession, sources: Sources) -> DataFrame:
    """Lines with what is to be known of each.

    These are its bytes, whether they are UTF-8, and whether a record may go on in the next
    line: where a quoted field is open at the end, or where a carriage return ends a record.
    """
    value, line = F.col("value"), F.col("__text")
    lines = _lines(spark, sources, lineSep="\n").withColumn("__text", records.without_return(value))
    return lines.select(
        PATH, "__block", "__text",
        (records.ends_inside(line) | F.contains(line, F.lit("\r"))).alias("__opens"),
        F.is_valid_utf8(value).alias("__valid"),
        (F.octet_length(value) + 1).cast("bigint").alias("__bytes"),
    )


def _parse(lines: DataFrame, files: DataFrame, names: list[str], count: int) -> DataFrame:
    """Lines as rows of all files' columns."""
    wanted = F.array(*[F.lit(name.lower()) for name in names])
    lowered = F.transform("names", F.lower)
    places = F.transform(wanted, lambda name: F.array_position(lowered, name).cast("int") - 1)
    facts = files.select(
        PATH, FILE, F.size("header").alias("__width"), F.col("text").alias("__header"),
        places.alias("__places"), SIZE,
    )
    line = F.col("__text")
    rows = attach(lines, facts, [PATH], "inner", count, SIZE, config.BYTES_PER_SALT)
    rows = rows.withColumn("__fields", records.fields(line))
    kind = (
        F.when(F.btrim(line, F.lit(" \t")) == "", BLANK)
        .when((F.col("__block") == 0) & (line == F.col("__header")), HEADER)
        .otherwise(DATA)
    )
    values = [
        na_to_null(F.get("__fields", F.get("__places", F.lit(n)))).alias(name)
        for n, name in enumerate(names)
    ]
    return rows.select(
        FILE, *values, (F.size("__fields") > F.col("__width")).alias(TOO_LONG), PATH,
        kind.cast("byte").alias(KIND), "__opens", "__valid", "__bytes",
    )


def scan(spark: SparkSession, sources: Sources, workspace: Workspace | None = None) -> Scan:
    """Read sources by one scan; reject those that cannot be read or lack columns."""
    workspace = workspace or Workspace(spark)
    files, size = _table_of_files(spark, sources, workspace)
    good, count = files, size["files"]
    if size["bad"]:
        bad = files.where("problem IS NOT NULL").select(FILE).distinct()
        good = workspace.stage(files.join(bad, FILE, "left_anti"), "good-files")
        if good.isEmpty():
            return Scan(None, _facts(files))
    names = size.get("names") or _all_names(good)
    parsed = workspace.stage(_parse(_plain_lines(spark, sources), good, names, count), "rows")
    summary = parsed.groupBy(PATH).agg(
        F.sum("__bytes").alias("read"), F.bool_and("__valid").alias("valid"),
        F.bool_or("__opens").alias("opens"), F.count_if(F.col(KIND) == HEADER).alias("headers"),
    )
    read = _with_problems(good.join(summary, PATH, "left"))
    counts = [
        F.count_if(F.col("problem").isNotNull()).alias("broken"), F.max("headers").alias("headers"),
    ]
    opens = F.col("problem").isNull() & F.col("opens")
    plain = F.col("problem").isNull() & ~F.coalesce("opens", F.lit(False))
    seen = read.agg(F.count_if(opens).alias("opens"), F.count_if(plain).alias("plain"), *counts).first()
    if seen["opens"] or seen["broken"]:
        read = workspace.stage(read, "read-files")
    if seen["opens"]:
        if not seen["plain"]:
            workspace.discard("rows")  # nothing of them is left
            parsed = None
        parsed, read = _with_records(spark, sources, parsed, read, names, seen["opens"], workspace)
        seen = read.agg(*counts).first()
    if seen["broken"]:
        late = read.where("problem IS NOT NULL").select(PATH, FILE, F.col("problem").alias("late"))
        parsed = attach(parsed, late.select(FILE).distinct(), [FILE], "left_anti")
        files = files.join(late.drop(FILE), PATH, "left").withColumn("problem", F.coalesce("problem", "late"))
    return Scan(_data_rows(parsed, names, seen["headers"] > 1), _facts(files))


def _said(reason: Column) -> Column:
    text = F.replace(F.lit(config.UNREADABLE_FILE), F.lit("{path}"), _plain(F.col(PATH)))
    return F.replace(text, F.lit("{reason}"), reason)


def _plain(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _with_problems(good: DataFrame) -> DataFrame:
    """Files that broke off while they were read, or hold other bytes than UTF-8."""
    read = F.coalesce("read", F.lit(0))
    short = F.format_string("only %d of %d bytes could be read", read, SIZE)
    problem = (
        F.when(read + MARK_BYTES < F.col(SIZE), _said(short))
        .when(~F.col("valid"), _said(F.lit("the text is not UTF-8")))
    )
    return good.withColumn("problem", problem)


def _with_records(spark, sources, parsed, good, names, count, workspace):
    """Files with records over several lines, read again by record."""
    opened = good.where("problem IS NULL AND opens").select(PATH)
    lines = _lines(spark, sources)
    if count <= NAMED_PATHS:  # a filter on paths keeps Spark from opening other files
        named = [row[PATH] for row in opened.collect()]
        named += [re.sub(r"^(\w+):/(?!/)", r"\1:///", path) for path in named]
        lines = lines.where(F.col("_metadata.file_path").isin(named))
    lines = lines.select(PATH, "__block", F.monotonically_increasing_id().alias("__line"), "value")
    lines = attach(lines, opened, [PATH], "left_semi", count)
    if count > config.BROADCAST_ROWS:
        lines = records.in_order(lines)
    whole, unclosed = records.assemble(lines, workspace)
    whole = whole.select(
        PATH, "__block", F.col("value").alias("__text"), F.lit(False).alias("__opens"),
        F.lit(True).alias("__valid"), F.lit(0).cast("bigint").alias("__bytes"),
    )
    again = workspace.stage(_parse(whole, good, names, good.count()), "records")
    workspace.discard("found")
    headers = again.groupBy(PATH).agg(F.count_if(F.col(KIND) == HEADER).alias("counted"))
    good = good.join(headers, PATH, "left").withColumn("headers", F.coalesce("counted", "headers"))
    good = good.drop("counted").join(unclosed, PATH, "left")
    unended = F.when(F.col("unclosed"), _said(F.lit("a quoted field is not closed")))
    good = good.withColumn("problem", F.coalesce("problem", unended)).drop("unclosed")
    if parsed is not None:
        again = attach(parsed, opened, [PATH], "left_anti", count).unionByName(again)
    return again, workspace.stage(good, "read-again")


def _data_rows(parsed: DataFrame, names: list[str], repeated: bool) -> DataFrame:
    """The rows without headers and blank lines.

    A header is known by its text. Where a file's first block holds that text again, all but
    one of these lines are data.
    """
    columns = [F.col(FILE), *[col(name) for name in names], F.col(TOO_LONG)]
    rows = parsed.where(F.col(KIND) == DATA).select(*columns)
    if not repeated:
        return rows
    again = parsed.where(F.col(KIND) == HEADER).groupBy(PATH, *columns).agg(F.count(F.lit(1)).alias("__times"))
    copies = F.explode(F.sequence(F.lit(2), F.col("__times").cast("int")))
    again = again.where("__times > 1").select(*columns, copies.alias("__copy"))
    return rows.unionByName(again.drop("__copy"))


def _facts(files: DataFrame) -> DataFrame:
    """One row per source: columns of its widest part, what its headers lack, why rejected."""
    reason = F.min_by("problem", F.when(F.col("problem").isNotNull(), F.col(PATH)))
    lacking = [F.bool_or(F.array_contains("missing", raw)) for raw in config.COLUMNS]
    names = [F.when(lacks, raw) for lacks, raw in zip(lacking, config.COLUMNS)]
    return files.groupBy(FILE).agg(
        F.coalesce(F.max(F.size("header")), F.lit(0)).alias("columns"),
        F.array_compact(F.array(*names)).alias("missing"), reason.alias("reason"),
    )
