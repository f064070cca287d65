"""SCADA-shaped views of the ``lineitem`` table, typed, raw and as CSV files.

Text is built from integers only, so that another engine writes the same text,
and powers are whole quarters, so that their sums are exact in any order.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.sources import storage
from anemoscope.sources.storage import Workspace

FARM = "concat('farm_', cast(l_suppkey % 4 AS string))"
_CSV_FOLDERS: dict[tuple, str] = {}


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def scada(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean table: typed, without duplicates to remove or nulls to fill."""
    return lineitem(spark, sf_dir).selectExpr(
        "l_shipdate AS date_time",
        "floor(l_extendedprice * 4) / 4 - 20000 AS active_power",
        "l_quantity AS wind_speed",
        "CASE WHEN l_linenumber = 7 THEN cast(0 AS double)"
        " ELSE l_extendedprice * (1 + l_tax) END AS theoretical_power",
        "cast((l_partkey * 37) % 3600 AS double) / 10 AS wind_direction",
        f"{FARM} AS source_file",
    )


def sparse_scada(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table with its days 40 days apart: most periods are empty."""
    days = F.datediff("date_time", F.lit("1992-01-01").cast("date"))
    stretched = F.date_add(F.lit("1700-01-01").cast("date"), days * 40)
    return scada(spark, sf_dir).withColumn(
        "date_time", stretched.cast("timestamp_ntz")
    )


def scada_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with junk, nulls and duplicate rows."""
    return _with_copies(
        _raw_rows(spark, sf_dir, "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')")
    )


def scada_mixed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text in which each farm writes its dates its own way.

    Farm 1 writes the day first, farm 2 has unreadable dates, farm 3 writes the
    ISO form without seconds.
    """
    date = (
        "CASE l_suppkey % 4"
        " WHEN 1 THEN date_format(l_shipdate, 'dd MM yyyy HH:mm')"
        " WHEN 2 THEN CASE WHEN l_linenumber = 7 THEN 'xx'"
        " ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END"
        " WHEN 3 THEN date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm\")"
        " ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END"
    )
    return _with_copies(_raw_rows(spark, sf_dir, date))


DATE_FORMS = [
    "M/d/yyyy h:mm:ss a", "MM/dd/yy HH:mm", "dd MMM yyyy HH:mm", "yyyyMMdd HH:mm:ss",
    "yyyy-MM-dd HH", "MMMM d, yyyy HH:mm", "dd-MMM-yyyy HH:mm:ss", "yyyyMMdd",
]


def scada_date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as spreadsheets and other programs write them, one form per order."""
    moment = (
        "cast(l_shipdate AS timestamp_ntz)"
        " + make_dt_interval(0, cast(l_orderkey % 24 AS int), cast(l_linenumber * 7 AS int))"
    )
    forms = "".join(
        f" WHEN {n} THEN date_format({moment}, '{form}')" for n, form in enumerate(DATE_FORMS)
    )
    return lineitem(spark, sf_dir).selectExpr(
        "l_orderkey", "l_linenumber",
        f"CASE l_orderkey % {len(DATE_FORMS)}{forms} END AS date_time",
    )


def scada_na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text in which every missing-value token turns up as a wind speed."""
    tokens = F.array(*[F.lit(token) for token in config.NA_TOKENS])
    token = F.element_at(tokens, (F.col("l_partkey") % len(config.NA_TOKENS) + 1).cast("int"))
    speed = F.col("l_quantity").cast("bigint").cast("string")
    return lineitem(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 3, token).otherwise(speed).alias("wind_speed"),
    )


def _raw_rows(spark, sf_dir, date) -> DataFrame:
    power = "cast(cast(floor(l_extendedprice) AS bigint) - 20000 AS string)"
    theory = "cast(cast(floor(l_extendedprice * (1 + l_tax)) AS bigint) AS string)"
    return lineitem(spark, sf_dir).selectExpr(
        "l_orderkey",
        f"CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {date} END AS date_time",
        "CASE WHEN l_orderkey % 97 = 0 THEN 'bad' WHEN l_orderkey % 89 = 0 THEN NULL"
        f" ELSE {power} END AS active_power",
        "CASE WHEN l_partkey % 53 = 0 THEN NULL"
        " ELSE cast(cast(l_quantity AS bigint) AS string) END AS wind_speed",
        "CASE WHEN l_partkey % 59 = 0 THEN 'oops' WHEN l_linenumber = 7 THEN '0'"
        f" ELSE {theory} END AS theoretical_power",
        "CASE WHEN l_suppkey % 31 = 0 THEN NULL"
        " ELSE cast((l_partkey * 37) % 360 AS string) END AS wind_direction",
        f"{FARM} AS source_file",
    )


def _with_copies(rows: DataFrame) -> DataFrame:
    copies = rows.filter("l_orderkey % 71 = 0")
    return rows.unionByName(copies).drop("l_orderkey")


def csv_folder(spark: SparkSession, sf_dir: str, view) -> str:
    """A raw view written as CSV sources, one per farm, once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, view.__name__)
    if key not in _CSV_FOLDERS:
        folder = f"{Workspace(spark).path}/{view.__name__}"
        named = view(spark, sf_dir).withColumn(
            "farm", F.concat(F.regexp_extract("source_file", r"(\d+)$", 1), F.lit(".csv"))
        )
        (
            named.drop("source_file")
            .withColumnsRenamed(config.RAW_HEADERS)
            .write.option("header", True)
            .partitionBy("farm")
            .csv(folder)
        )
        _CSV_FOLDERS[key] = folder
    return _CSV_FOLDERS[key]


def scada_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies whose powers are spelled differently: whole, with fractions, with text, with gaps."""
    large = "WHEN 1 THEN '9007199254740992' WHEN 2 THEN '9007199254740993'"
    whole = f"CASE l_linenumber {large} WHEN 3 THEN '1' WHEN 4 THEN ' 1' ELSE '01' END"
    spelled = f"CASE l_linenumber {large} WHEN 3 THEN '1' WHEN 4 THEN '1.0' WHEN 5 THEN '1e0' ELSE ' 1' END"
    return lineitem(spark, sf_dir).selectExpr(
        f"{FARM} AS source_file",
        "date_format(l_shipdate, 'yyyy-MM-01 00:00:00') AS date_time",
        f"CASE l_suppkey % 4 WHEN 0 THEN {whole} WHEN 1 THEN {spelled}"
        f" WHEN 2 THEN CASE WHEN l_linenumber = 7 THEN 'bad' ELSE {spelled} END"
        f" ELSE CASE WHEN l_linenumber < 7 THEN {whole} END END AS active_power",
        "'5' AS wind_speed", "'6' AS theoretical_power", "'7' AS wind_direction",
    )


# --- Files that no writer of Spark's would write ---------------------------------------

RAW = config.RAW_HEADERS
STANDARD = ["date_time", "active_power", "wind_speed", "theoretical_power", "wind_direction"]


def _header(names) -> str:
    return ",".join(RAW.get(name, name) for name in names)


def _joined(names, **instead) -> str:
    """SQL of a line with these fields, nulls as nothing."""
    fields = [instead.get(name, f"coalesce({name}, '')") for name in names]
    return "concat_ws(',', " + ", ".join(fields) + ")"


def _quoted(text: str) -> str:
    return f"""concat('"', replace({text}, '"', '""'), '"')"""


def quoted_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with three notes: some with line breaks, commas and quotes."""
    rows = _raw_rows(spark, sf_dir, "date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')").drop("l_orderkey")
    n = "coalesce(wind_speed, '0')"
    return rows.selectExpr(
        "*",
        f"CASE WHEN {n} % 5 = 0 THEN concat('first\\nof ', {n}) ELSE concat('f', {n}) END AS note_a",
        f"CASE WHEN {n} % 3 = 0 THEN concat('said \"stop, now\"\\n\\n', {n}, ',') END AS note_b",
        f"CASE WHEN {n} % 4 = 0 THEN concat({n}, '\\nend \"') ELSE concat({n}, '\" pipe') END AS note_c",
    )


def quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes first, in the middle and last in their records, quoted where they must be."""
    names = ["note_a", "date_time", "active_power", "note_b", "wind_speed", "theoretical_power", "wind_direction", "note_c"]
    line = _joined(
        names, note_a=f"CASE WHEN contains(note_a, '\\n') THEN {_quoted('note_a')} ELSE note_a END",
        note_b=f"coalesce({_quoted('note_b')}, '')",
        note_c=f"CASE WHEN contains(note_c, '\\n') THEN {_quoted('note_c')} ELSE note_c END",
    )
    return _with_headers(
        quoted_notes(spark, sf_dir).selectExpr("source_file", f"{line} AS line"),
        dict.fromkeys(range(4), _header(names)),
    )


LAYOUTS = {
    0: STANDARD,
    1: [config.RAW_WIND_DIRECTION_ALIAS, "site", "date_time", "active_power", "wind_speed", "theoretical_power"],
    2: [*STANDARD, "SITE"],
    3: ["theoretical_power", "wind_speed", "note", "active_power", "date_time", "wind_direction"],
}


def layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header of its own for every farm: order, alias, extra columns and short rows."""
    lines = {
        0: _joined(LAYOUTS[0]),
        1: _joined(["wind_direction", *LAYOUTS[1][1:]], site="'a'"),
        2: "CASE WHEN wind_speed IS NULL THEN " + _joined(STANDARD[:2])
        + " ELSE " + _joined(LAYOUTS[2], SITE="""'"b,c"'""") + " END",
        3: _joined(LAYOUTS[3], note="'NA'"),
    }
    whens = "".join(f" WHEN '{farm}' THEN {line}" for farm, line in lines.items())
    rows = scada_raw(spark, sf_dir).selectExpr(
        "source_file", f"CASE right(source_file, 1){whens} END AS line"
    )
    return _with_headers(rows, {farm: _header(names) for farm, names in LAYOUTS.items()})


def failing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good farm, one that lacks columns, one with long rows, and one that is not UTF-8."""
    line = _joined(STANDARD)
    rows = scada_raw(spark, sf_dir).selectExpr(
        "source_file",
        f"CASE WHEN wind_speed = '7' AND source_file = 'farm_2' THEN concat({line}, ',')"
        f" WHEN wind_speed = '7' AND source_file = 'farm_3' THEN concat({line}, cast(unhex('E9') AS string))"
        f" ELSE {line} END AS line",
    )
    lacking = "Date/Time,LV ActivePower (kW),speed,Theoretical_Power_Curve (KWh),direction"
    return _with_headers(rows, dict.fromkeys(range(4), _header(STANDARD)) | {1: lacking})


def _with_headers(rows: DataFrame, headers: dict) -> DataFrame:
    spark = rows.sparkSession
    first = spark.createDataFrame(
        [(f"farm_{farm}", text, 0) for farm, text in headers.items()],
        "source_file string, line string, place int",
    )
    return first.unionByName(rows.withColumn("place", F.lit(1)))


#: Bytes of the table to a part file of a farm: bounds what the task that writes it sorts.
BYTES_PER_PART, FARMS = 32_000_000, 4


def line_folder(spark: SparkSession, sf_dir: str, view) -> str:
    """Lines written as CSV sources, once per session.

    A farm is one part file, or several by the size of the table, each with the header first.
    """
    key = (spark.sparkContext.applicationId, sf_dir, view.__name__)
    if key not in _CSV_FOLDERS:
        folder = f"{Workspace(spark).path}/{view.__name__}"
        size = storage.size_of(spark, f"{sf_dir}/lineitem.parquet")
        parts = max(1, -(-size // (FARMS * BYTES_PER_PART)))
        number = F.regexp_extract("source_file", r"(\d+)$", 1)
        part = F.when(F.col("place") == 0, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(
            F.array(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int"))
        )
        place = F.pmod(F.coalesce(number.try_cast("int"), F.lit(0)), F.lit(FARMS)) * parts
        with storage.shuffles_removed(spark):
            (
                view(spark, sf_dir).withColumn("farm", F.concat(number, F.lit(".csv")))
                .withColumn("part", F.explode(part))
                .repartitionById(FARMS * parts, place + F.col("part"))
                .sortWithinPartitions("farm", "place").select("line", "farm")
                .write.partitionBy("farm").text(folder)
            )
        _CSV_FOLDERS[key] = folder
    return _CSV_FOLDERS[key]
