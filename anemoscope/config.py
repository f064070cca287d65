"""Names, thresholds and texts shared by the whole package."""

# --- Fixed values: headers of the SCADA export -------------------------------
RAW_DATE_TIME = "Date/Time"
RAW_ACTIVE_POWER = "LV ActivePower (kW)"
RAW_WIND_SPEED = "Wind Speed (m/s)"
RAW_THEORETICAL_POWER = "Theoretical_Power_Curve (KWh)"
RAW_WIND_DIRECTION = "Wind Direction (°)"
RAW_WIND_DIRECTION_ALIAS = "Wind Direction (degrees)"

# Column names inside the package, keyed by raw header.
COLUMNS = {
    RAW_DATE_TIME: "date_time",
    RAW_ACTIVE_POWER: "active_power",
    RAW_WIND_SPEED: "wind_speed",
    RAW_THEORETICAL_POWER: "theoretical_power",
    RAW_WIND_DIRECTION: "wind_direction",
}
RAW_HEADERS = {name: raw for raw, name in COLUMNS.items()}
METRICS = ["active_power", "wind_speed", "theoretical_power", "wind_direction"]
MEDIAN_FILLED = ["wind_speed", "theoretical_power", "wind_direction"]
SOURCE_FILE = "source_file"
# Columns that operators add to rows that still have a file's extra columns.
OWN_COLUMNS = {"efficiency_ratio"}

# --- Fixed values: tokens read as missing -------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- Fixed values: number and date grammar -------------------------------------
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"
INTEGER = r"^\s*[+-]?\d+\s*$"
BOOLEANS = ["True", "TRUE", "true", "False", "FALSE", "false"]

PADDED_DATE = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"
STRICT_DATE = (
    r"^\d{4}-(1[0-2]|0?[1-9])-(3[01]|[12]\d|0?[1-9])"
    r"\s+(2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d$"
)
CLOCK = r"(?:(?:\s+|T)(\d{1,2})(?::(\d{1,2})(?::(\d{1,2}(?:\.\d{1,9})?))?)?)?\s*$"
YEAR_FIRST_DATE = r"^\s*(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})" + CLOCK
MONTH_FIRST_DATE = r"^\s*(1[0-2]|0?[1-9])[-/. ](\d{1,2})[-/. ](\d{4})" + CLOCK
DAY_FIRST_DATE = r"^\s*(\d{1,2})[-/. ](1[0-2]|0?[1-9])[-/. ](\d{4})" + CLOCK

MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"(?i:(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    r"|sep(?:t|tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?))"
)
WEEKDAY = (
    r"(?i)\b(mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?)\b[,.]?\s*"
)
MERIDIEM = r"(?i)(\d)\s*([ap])m\s*$"
NAME_SECOND = r"^\s*(\d{1,2})[-/ .]+" + _MONTH + r"[-/ .,]+(\d{4}|\d{2})(\D.*)?$"
NAME_FIRST = r"^\s*" + _MONTH + r"[-/ .]+(\d{1,2})(?:,\s*|[-/ .]+)(\d{4}|\d{2})(\D.*)?$"
NAME_AFTER_YEAR = r"^\s*(\d{4}|3[2-9]|[4-9]\d)[-/ .]+" + _MONTH + r"[-/ .,]+(\d{1,2})(\D.*)?$"
CLOCK_BEFORE_YEAR = r"^\s*" + _MONTH + r"\s+(\d{1,2})\s+(\d{1,2}:\d{1,2}(?::\d{1,2})?)\s+(\d{4})\s*$"
NAME_AND_YEAR = r"^\s*" + _MONTH + r"[-/ .,]+(\d{4})\s*$"
YEAR_AND_MONTH = r"^\s*(\d{4})[-/.](\d{1,2})\s*$"
COMPACT = r"^\s*(\d{4})(\d\d)(\d\d)(?:[ T]*(\d\d):?(\d\d):?(\d\d)?)?\s*$"
SHORT_YEAR = r"^\s*(\d{1,2})([-/.])(\d{1,2})[-/.](\d{2})(\D.*)?$"
SHORT_YEAR_FIRST = r"^\s*(3[2-9]|[4-9]\d)[-/.](\d{1,2})[-/.](\d{1,2})(\D.*)?$"

# Timestamps outside this range do not fit 64-bit nanoseconds and are rejected.
EARLIEST = "1677-09-21 00:12:43.145225"
LATEST = "2262-04-11 23:47:16.854775"

# --- Fixed values: analysis parameters ----------------------------------------
WIND_DIRECTION_BINS = 16
MIN_THEORETICAL_POWER = 0.0  # exclusive
MIN_ACTIVE_POWER = 0.0  # exclusive
SAMPLE_MINUTES = 10
QUARTILES = [0.25, 0.5, 0.75]

# --- Fixed values: audit log --------------------------------------------------
LOG_FIELDS = [
    "run_id", "run_timestamp", "column", "issue_type", "row_count",
    "action_taken",
]

# --- Fixed values: display headers --------------------------------------------
DISPLAY_HEADERS = {
    "date_time": "Timestamp",
    "active_power": "Active Power (kW)",
    "wind_speed": "Wind Speed (m/s)",
    "theoretical_power": "Theoretical Power (kWh)",
    "wind_direction": "Wind Direction (°)",
    "efficiency_ratio": "Efficiency Ratio",
}
MONTHLY_SECTION = "Monthly Mean Active Power"
DAILY_SECTION = "Daily Total Active Power"

# --- Fixed values: report texts ------------------------------------------------
NARRATIVE = (
    "This report analyses %s hours of operational wind turbine data. "
    "The turbine produced a mean active power output of %s kW "
    "across all operational periods. "
    "Overall efficiency against the theoretical power curve averaged "
    "%s%%, indicating the proportion of available wind energy "
    "converted to output. "
    "Peak mean output occurred in %s, suggesting strong seasonal "
    "wind resource during this period."
)
HEADLINE_LABELS = [
    "Mean Active Power (kW)",
    "Max Active Power (kW)",
    "Std Dev Active Power (kW)",
    "Mean Wind Speed (m/s)",
    "Max Wind Speed (m/s)",
    "Mean Efficiency Ratio (%)",
    "Total Rows Analysed",
    "Rows Excluded from Efficiency",
]

# --- Fixed values: report members, in sheet order ------------------------------
REPORT_MEMBERS = [
    "summary", "clean_data", "trend_analysis", "power_curve_analysis",
    "charts", "data_quality_log",
]

# --- Fixed values: user-facing messages ----------------------------------------
FILE_NOT_FOUND = "Error: File not found — {path}"
UNREADABLE_FILE = "Error: Could not read file — {path}\nReason: {reason}"
SCHEMA_FAILED = (
    "Error: Schema validation failed.\n"
    "Missing columns: {missing}\n"
    "Expected columns: {expected}"
)
FOLDER_NOT_FOUND = "Error: Folder not found — {path}"
NO_CSV_FILES = "Error: No .csv files found in {path}"
DATE_FAILED = (
    "Error: Could not parse date column 'Date/Time'.\n"
    "Primary format '%Y-%m-%d %H:%M:%S' failed.\n"
    "Inference also failed: {reason}"
)
NOTHING_PROCESSED = (
    "Error: No files were successfully processed. "
    "Check the [SKIP] messages above for details."
)
BOTH_INPUTS = "Error: Provide either --file or --folder, not both."
NO_INPUT = "Error: You must provide either --file or --folder."
DATES_INFERRED = "[WARN] Date format inferred — verify output timestamps"

# --- Fixed values: progress lines ------------------------------------------------
FOUND_FILES = "[BATCH] Found {count} CSV file(s) in {folder}"
PROCESSING = "\n[BATCH] Processing: {name}"
SKIPPED = "[SKIP] {name} — {reason}"
CONCATENATING = "\n[BATCH] Concatenating {count} cleaned file(s)..."
CONSOLIDATED = "[BATCH] Consolidated: {rows:,} total rows"
LOADED = "[LOAD] {rows:,} rows × {columns} columns"
CLEANED = "[CLEAN] {rows:,} rows in → {kept:,} rows clean ({dropped:,} dropped)"
EXCLUDED = (
    "[ANALYSE] {rows:,} rows excluded from efficiency "
    "(zero theoretical or non-positive output)"
)
ANALYSING, EXPORTING = "[ANALYSE]", "[EXPORT]"
SAVED = "Report saved → {path}"

# --- Size bounds of this package ------------------------------------------------
# Lookup tables hold one short row per file; above this many rows they are
# joined with salted keys instead of being broadcast.
BROADCAST_ROWS = 100_000
SALTS = 64
# At most so many groups of such a join are spread over several tasks.
SPREAD_GROUPS = 100_000
# Rows, or bytes of text, of a group that one task of such a join takes.
ROWS_PER_SALT = 1_000_000
BYTES_PER_SALT = 64_000_000
# Above this many values in one group, exact quantiles are found by narrowing a
# bracket instead of holding the group's values in one aggregation buffer.
QUANTILE_BUFFER_ROWS = 1_000_000
