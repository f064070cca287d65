"""The registered queries as SQL over the same tables."""

from anemoscope import config

METRICS = config.METRICS
FILLED = config.MEDIAN_FILLED
STRICT = "%Y-%m-%d %H:%M:%S"
FARM = "concat('farm_', CAST(l_suppkey % 4 AS VARCHAR))"
CSV_FARM = "concat('farm=', CAST(l_suppkey % 4 AS VARCHAR), '.csv')"
PLAIN_DATES = f"strftime(l_shipdate, '{STRICT}')"
MIXED_DATES = f"""
  CASE l_suppkey % 4
    WHEN 1 THEN strftime(l_shipdate, '%d %m %Y %H:%M')
    WHEN 2 THEN CASE WHEN l_linenumber = 7 THEN 'xx'
                     ELSE strftime(l_shipdate, '{STRICT}') END
    WHEN 3 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M')
    ELSE strftime(l_shipdate, '{STRICT}') END"""

SCADA = f"""scada AS (
  SELECT l_shipdate AS date_time, floor(l_extendedprice * 4) / 4 - 20000 AS active_power,
    l_quantity AS wind_speed,
    CASE WHEN l_linenumber = 7 THEN CAST(0 AS DOUBLE)
         ELSE l_extendedprice * (1 + l_tax) END AS theoretical_power,
    CAST((l_partkey * 37) % 3600 AS DOUBLE) / 10 AS wind_direction,
    {FARM} AS source_file
  FROM lineitem)"""

SPARSE = SCADA + """, sparse AS (
  SELECT CAST(DATE '1700-01-01' + CAST(40 * date_diff('day', TIMESTAMP '1992-01-01', date_time) AS INTEGER)
              AS TIMESTAMP) AS date_time, active_power
  FROM scada)"""

OPERATIONAL = SCADA + """, operational AS (
  SELECT * FROM scada WHERE theoretical_power > 0 AND active_power > 0)"""


def raw(date=PLAIN_DATES, farm=FARM):
    columns = "date_time, active_power, wind_speed, theoretical_power, wind_direction, source_file"
    return f"""r AS (
  SELECT l_orderkey AS ok,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {date} END AS date_time,
    CASE WHEN l_orderkey % 97 = 0 THEN 'bad' WHEN l_orderkey % 89 = 0 THEN NULL
         ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) - 20000 AS VARCHAR) END AS active_power,
    CASE WHEN l_partkey % 53 = 0 THEN NULL
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS wind_speed,
    CASE WHEN l_partkey % 59 = 0 THEN 'oops' WHEN l_linenumber = 7 THEN '0'
         ELSE CAST(CAST(floor(l_extendedprice * (1 + l_tax)) AS BIGINT) AS VARCHAR)
         END AS theoretical_power,
    CASE WHEN l_suppkey % 31 = 0 THEN NULL
         ELSE CAST((l_partkey * 37) % 360 AS VARCHAR) END AS wind_direction,
    {farm} AS source_file
  FROM lineitem),
raw AS (SELECT {columns} FROM r UNION ALL SELECT {columns} FROM r WHERE ok % 71 = 0)"""


TYPED_COLUMNS = ", ".join(
    f"TRY_CAST({m} AS DOUBLE) AS {m}, ({m} IS NOT NULL AND TRY_CAST({m} AS DOUBLE) IS NULL)"
    f" AS {m}_invalid"
    for m in METRICS
)


def typed(source):
    return f"typed AS (SELECT source_file, date_time, {TYPED_COLUMNS} FROM {source})"


KEPT = "kept AS (SELECT * FROM typed WHERE date_time IS NOT NULL AND active_power IS NOT NULL)"
DISTINCT = "distinct_rows AS (SELECT DISTINCT * FROM raw)"
PARSED = f"""COALESCE(TRY_STRPTIME(date_time, '{STRICT}'),
  TRY_STRPTIME(date_time, '%Y-%m-%dT%H:%M'),
  TRY_STRPTIME(date_time, '%m %d %Y %H:%M'),
  TRY_STRPTIME(date_time, '%d %m %Y %H:%M'))"""
MEDIANS = "medians AS (SELECT source_file, " + ", ".join(
    f"median({m}) AS {m}_median" for m in FILLED
) + " FROM kept GROUP BY source_file)"
FILLED_COLUMNS = ", ".join(f"COALESCE(k.{m}, m.{m}_median) AS {m}" for m in FILLED)


def parsed_dates(date):
    return f"""WITH {raw(date)}
SELECT source_file, {PARSED} AS date_time,
  CASE WHEN date_time IS NULL THEN NULL
       WHEN TRY_STRPTIME(date_time, '{STRICT}') IS NOT NULL THEN 'strict'
       WHEN {PARSED} IS NOT NULL THEN 'flexible' ELSE 'failed' END AS date_format,
  wind_direction
FROM raw"""


def clean(farm):
    return f"""WITH {raw(farm=farm)}, {DISTINCT}, {typed('distinct_rows')}, {KEPT}, {MEDIANS}
SELECT k.source_file, {PARSED} AS date_time, active_power, {FILLED_COLUMNS}
FROM kept k JOIN medians m USING (source_file)"""


def null_counts(source):
    dated = "date_time IS NOT NULL"
    kept = f"{dated} AND active_power IS NOT NULL"
    conditions = {"date_time": "date_time IS NULL", "active_power": f"{dated} AND active_power IS NULL"}
    conditions |= {m: f"{kept} AND {m} IS NULL" for m in FILLED}
    return "\nUNION ALL\n".join(
        f"SELECT source_file, '{name}' AS \"column\", count(*) FILTER ({condition}) AS row_count"
        f" FROM {source} GROUP BY source_file"
        for name, condition in conditions.items()
    )


def quality_log(date=PLAIN_DATES, only=""):
    raw_names = config.RAW_HEADERS
    entries = [
        "SELECT source_file, 'row' AS \"column\", 'duplicate' AS issue_type,"
        " b.n - d.n AS row_count, 'dropped' AS action_taken"
        " FROM (SELECT source_file, count(*) n FROM raw GROUP BY 1) b"
        " JOIN (SELECT source_file, count(*) n FROM distinct_rows GROUP BY 1) d USING (source_file)"
    ]
    entries += [
        f"SELECT source_file, '{raw_names[m]}', 'type_coercion',"
        f" count(*) FILTER ({m}_invalid), 'coerced' FROM typed GROUP BY 1"
        for m in METRICS
    ]
    for name in ("date_time", "active_power", *FILLED):
        action = "filled_median" if name in FILLED else "dropped"
        entries.append(
            f"SELECT source_file, '{raw_names[name]}', 'null', row_count, '{action}'"
            f" FROM nulls WHERE \"column\" = '{name}'"
        )
    entries.append(
        f"SELECT source_file, '{raw_names['date_time']}',"
        f" CASE WHEN bool_and(TRY_STRPTIME(date_time, '{STRICT}') IS NOT NULL)"
        " THEN 'type_coercion' ELSE 'date_parse_failure' END, 0, 'coerced'"
        f" FROM kept GROUP BY 1 HAVING bool_and({PARSED} IS NOT NULL)"
    )
    log = "\nUNION ALL\n".join(entries)
    return f"""WITH {raw(date)}, {DISTINCT}, {typed('distinct_rows')}, {KEPT},
nulls AS ({null_counts('typed')}),
log AS ({log})
{only or 'SELECT source_file, "column", issue_type, CAST(row_count AS BIGINT) AS row_count, action_taken FROM log'}"""


def monthly(source="scada"):
    return f"""monthly_sums AS (
  SELECT CAST(date_trunc('month', date_time) AS TIMESTAMP) AS period_start,
    avg(active_power) AS active_power FROM {source} GROUP BY 1),
monthly AS (
  SELECT s.period_start, m.active_power
  FROM (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL 1 MONTH))
          AS period_start FROM monthly_sums) s
  LEFT JOIN monthly_sums m USING (period_start))"""


def daily(source="scada"):
    return f"""daily_sums AS (
  SELECT CAST(date_trunc('day', date_time) AS TIMESTAMP) AS period_start,
    sum(active_power) AS active_power FROM {source} GROUP BY 1),
daily AS (
  SELECT s.period_start, COALESCE(d.active_power, 0.0) AS active_power
  FROM (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL 1 DAY))
          AS period_start FROM daily_sums) s
  LEFT JOIN daily_sums d USING (period_start))"""


HOURLY = """hourly_sums AS (
  SELECT date_trunc('hour', date_time) AS period_start,
    avg(active_power) AS active_power FROM scada GROUP BY 1),
hourly AS (
  SELECT s.period_start, h.active_power
  FROM (SELECT unnest(generate_series(min(period_start), max(period_start), INTERVAL 1 HOUR))
          AS period_start FROM hourly_sums) s
  LEFT JOIN hourly_sums h USING (period_start))"""

PEAK = """peak AS (
  SELECT period_start, active_power,
    concat(monthname(period_start), ' ', CAST(year(period_start) AS VARCHAR)) AS month_label
  FROM monthly WHERE active_power IS NOT NULL
  ORDER BY active_power DESC, period_start LIMIT 1)"""

HEADLINE = """facts AS (
  SELECT avg(active_power) AS mean_power, max(active_power) AS max_power,
    stddev_samp(active_power) AS std_power, avg(wind_speed) AS mean_speed,
    max(wind_speed) AS max_speed,
    avg(active_power / theoretical_power)
      FILTER (theoretical_power > 0 AND active_power > 0) * 100 AS mean_percent,
    count(*) FILTER (theoretical_power > 0 AND active_power > 0) AS operational_rows,
    count(*) FILTER (NOT (theoretical_power > 0 AND active_power > 0)) AS excluded_rows
  FROM scada)"""

DESCRIBE = f"WITH {SCADA}\n" + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS statistic, "
    + ", ".join(f"round({form.format(c=c)}, 4) AS {c}" for c in ("active_power", "wind_speed"))
    + " FROM scada"
    for name, form in {
        "count": "CAST(count({c}) AS DOUBLE)", "mean": "avg({c})", "std": "stddev_samp({c})",
        "min": "min({c})", "25%": "quantile_cont({c}, 0.25)", "50%": "quantile_cont({c}, 0.5)",
        "75%": "quantile_cont({c}, 0.75)", "max": "max({c})",
    }.items()
)

OBSERVED_EDGES = """e AS (
  SELECT k, CASE WHEN k = 0 THEN mn - (mx - mn) * 0.001::DOUBLE WHEN k = 16 THEN mx
                 ELSE mn + CAST(k AS DOUBLE) * ((mx - mn) / 16) END AS edge
  FROM (SELECT min(wind_direction) AS mn, max(wind_direction) AS mx FROM scada), range(17) t(k))"""
COMPASS_EDGES = "e AS (SELECT k, CAST(k AS DOUBLE) * 22.5::DOUBLE AS edge FROM range(17) t(k))"
EDGE_LABEL = """CAST(CASE WHEN abs({e}) < 1 AND {e} <> 0
  THEN round_even({e} * pow(10, 2 - floor(log10(abs({e})))), 0) / pow(10, 2 - floor(log10(abs({e}))))
  ELSE round_even({e} * 1000, 0) / 1000 END AS VARCHAR)"""


def bins(edges, lowest):
    lower, upper = EDGE_LABEL.format(e="a.edge"), EDGE_LABEL.format(e="b.edge")
    return f"""{edges},
bins AS (SELECT CAST(a.k + 1 AS INTEGER) AS bin_index, a.edge AS bin_lower, b.edge AS bin_upper,
    concat('(', {lower}, ', ', {upper}, ']') AS wind_direction_bin
  FROM e a JOIN e b ON b.k = a.k + 1),
bin_counts AS (SELECT bin_index, bin_lower, bin_upper, wind_direction_bin,
    count(s.wind_direction) AS count
  FROM bins LEFT JOIN scada s ON s.wind_direction <= bin_upper
    AND (s.wind_direction > bin_lower {lowest})
  GROUP BY ALL)"""


OBSERVED_BINS = bins(OBSERVED_EDGES, "")
COMPASS_BINS = bins(COMPASS_EDGES, "OR (bin_index = 1 AND s.wind_direction = bin_lower)")
BIN_COLUMNS = "SELECT bin_index, bin_lower, bin_upper, wind_direction_bin, count FROM bin_counts"


def headers(columns):
    return ", ".join(f'{c} AS "{config.DISPLAY_HEADERS.get(c, c)}"' for c in columns)


def trend(with_clause):
    section = """SELECT {n} AS section_ord, '{title}' AS section,
  CAST(row_number() OVER (ORDER BY period_start) AS INTEGER) AS ord,
  strftime(period_start, '%Y-%m-%d') AS "Date",
  round_even(active_power * 100, 0) / 100 AS "Active Power (kW)" FROM {table}"""
    return (
        f"WITH {with_clause}\n"
        + section.format(n=1, title=config.MONTHLY_SECTION, table="monthly")
        + "\nUNION ALL\n"
        + section.format(n=2, title=config.DAILY_SECTION, table="daily")
    )


def narrative():
    parts = config.NARRATIVE.replace("%%", "%").split("%s")
    values = [
        "format('{:,}', CAST(round_even(operational_rows * 10 / 60, 0) AS BIGINT))",
        "format('{:,.1f}', mean_power)",
        "replace(format('{:.1f}', mean_percent), ',', '')",
        "(SELECT month_label FROM peak)",
    ]
    pieces = [f"'{parts[0]}'"]
    for value, text in zip(values, parts[1:]):
        pieces += [value, f"'{text}'"]
    return f"WITH {SCADA}, {monthly()}, {PEAK}, {HEADLINE} SELECT concat({', '.join(pieces)}) AS narrative FROM facts"


def headline():
    names = ["mean_power", "max_power", "std_power", "mean_speed", "max_speed", "mean_percent"]
    values = [f"round_even({name} * 100, 0) / 100" for name in names]
    values += ["CAST(operational_rows AS DOUBLE)", "CAST(excluded_rows AS DOUBLE)"]
    return f"WITH {SCADA}, {HEADLINE}\n" + "\nUNION ALL\n".join(
        f"SELECT {i} AS ord, '{label}' AS metric, {value} AS value FROM facts"
        for i, (label, value) in enumerate(zip(config.HEADLINE_LABELS, values), start=1)
    )


def csv_clean_scada():
    """The cleaned CSV folder under the names the trend sheet uses."""
    return f"clean AS ({clean(CSV_FARM)})"


def of_report(sql):
    """SQL of an analysis over the cleaned CSV folder in place of the clean view."""
    clean_view = f"scada AS ({clean(CSV_FARM)})"
    return sql.replace(SCADA, clean_view)


RATIO = "date_time, active_power, wind_speed, theoretical_power, active_power / theoretical_power AS efficiency_ratio"
RATIOS = f"{OPERATIONAL}, ratios AS (SELECT {RATIO} FROM operational)"
EFFICIENCY_COLUMNS = ["date_time", "active_power", "wind_speed", "theoretical_power", "efficiency_ratio"]
CLEAN_COLUMNS = ["date_time", "active_power", "wind_speed", "theoretical_power", "wind_direction", "source_file"]
PERIODS = "SELECT period_start, active_power FROM"


def na_tokens():
    tokens = ", ".join(f"'{token}'" for token in config.NA_TOKENS)
    return f"""SELECT l_orderkey, l_linenumber,
  CASE WHEN speed NOT IN ({tokens}) THEN speed END AS wind_speed
FROM (SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 3 THEN ([{tokens}])[l_partkey % {len(config.NA_TOKENS)} + 1]
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS speed
  FROM lineitem)"""


def skipped():
    message = config.DATE_FAILED.replace("'", "''").split("{reason}")[0]
    return f"""WITH {raw(MIXED_DATES, CSV_FARM)}, {DISTINCT}, {typed('distinct_rows')}, {KEPT}
SELECT source_file, 'clean' AS stage,
  concat('{message}', CAST(count(*) AS VARCHAR), ' value(s) match no supported date format') AS reason
FROM kept WHERE {PARSED} IS NULL GROUP BY source_file"""


def spellings():
    large = "WHEN 1 THEN '9007199254740992' WHEN 2 THEN '9007199254740993'"
    whole = f"CASE l_linenumber {large} WHEN 3 THEN '1' WHEN 4 THEN ' 1' ELSE '01' END"
    spelled = f"CASE l_linenumber {large} WHEN 3 THEN '1' WHEN 4 THEN '1.0' WHEN 5 THEN '1e0' ELSE ' 1' END"
    number = "CAST(TRY_CAST(trim(power) AS DOUBLE) AS VARCHAR)"
    return f"""WITH spelled AS (
  SELECT l_suppkey % 4 AS farm, strftime(l_shipdate, '%Y-%m-01 00:00:00') AS date_time,
    CASE l_suppkey % 4 WHEN 0 THEN {whole} WHEN 1 THEN {spelled}
      WHEN 2 THEN CASE WHEN l_linenumber = 7 THEN 'bad' ELSE {spelled} END
      ELSE CASE WHEN l_linenumber < 7 THEN {whole} END END AS power
  FROM lineitem),
kinds AS (SELECT farm, bool_or(power = 'bad') AS text, bool_and(power IS NOT NULL) AS filled,
    bool_and(TRY_CAST(power AS DOUBLE) IS NULL OR NOT regexp_matches(power, '[.e]')) AS whole
  FROM spelled GROUP BY farm),
keyed AS (SELECT DISTINCT farm, date_time,
    CASE WHEN text THEN power WHEN whole AND filled THEN CAST(TRY_CAST(trim(power) AS BIGINT) AS VARCHAR)
      ELSE {number} END AS power
  FROM spelled JOIN kinds USING (farm))
SELECT concat('farm_', CAST(farm AS VARCHAR)) AS source_file, date_time,
  TRY_CAST(trim(power) AS DOUBLE) AS active_power, coalesce(power = 'bad', false) AS active_power_invalid
FROM keyed"""


def quoted():
    n, lf = "CAST(coalesce(wind_speed, '0') AS BIGINT)", "chr(10)"
    return f"""WITH {raw(farm=CSV_FARM)}
SELECT {", ".join(("date_time", *METRICS, "source_file"))},
  CASE WHEN {n} % 5 = 0 THEN concat('first', {lf}, 'of ', {n}) ELSE concat('f', {n}) END AS note_a,
  CASE WHEN {n} % 3 = 0 THEN concat('said "stop, now"', {lf}, {lf}, {n}, ',') END AS note_b,
  CASE WHEN {n} % 4 = 0 THEN concat({n}, {lf}, 'end "') ELSE concat({n}, '" pipe') END AS note_c
FROM r"""


def layouts():
    short = "source_file LIKE '%2.csv' AND wind_speed IS NULL"
    extras = "site, note"
    return f"""WITH {raw(farm=CSV_FARM)},
laid_out AS (SELECT source_file, date_time, active_power, wind_speed,
    CASE WHEN {short} THEN NULL ELSE theoretical_power END AS theoretical_power,
    CASE WHEN {short} THEN NULL ELSE wind_direction END AS wind_direction,
    CASE WHEN source_file LIKE '%1.csv' THEN 'a'
         WHEN source_file LIKE '%2.csv' AND wind_speed IS NOT NULL THEN 'b,c' END AS site,
    CAST(NULL AS VARCHAR) AS note
  FROM raw),
distinct_rows AS (SELECT DISTINCT * FROM laid_out),
typed AS (SELECT source_file, date_time, {TYPED_COLUMNS}, {extras} FROM distinct_rows), {KEPT}, {MEDIANS}
SELECT k.source_file, {PARSED} AS date_time, active_power, {FILLED_COLUMNS}, {extras}
FROM kept k JOIN medians m USING (source_file)"""


def failing(columns):
    lacking = f"{config.RAW_WIND_SPEED}, {config.RAW_WIND_DIRECTION}"
    named = lacking.replace(", ", "', '")
    schema = config.SCHEMA_FAILED.format(missing=f"['{named}']", expected=list(config.COLUMNS))
    unreadable = config.UNREADABLE_FILE.format(path="farm=%s.csv", reason="%s")
    reasons = {
        1: schema, 2: unreadable % (2, "a row has more fields than the header"),
        3: unreadable % (3, "the text is not UTF-8"),
    }
    rows = ", ".join(
        "({}, {}, '{}', 'load', {})".format(
            f"'farm={farm}.csv'", farm != 1, lacking if farm == 1 else "",
            "'" + reasons[farm].replace("'", "''") + "'" if farm in reasons else "NULL",
        )
        for farm in range(4)
    )
    table = f"(VALUES {rows}) AS f(source_file, valid, missing, stage, reason)"
    return f"""WITH {raw(farm=CSV_FARM)}
SELECT {columns} FROM {table} WHERE source_file IN (SELECT source_file FROM raw)"""


def oracle_sql() -> dict[str, str]:
    file_rows = f"WITH {raw(farm=CSV_FARM)} SELECT source_file, count(*) AS rows"
    return {
        "scan_csv": f"WITH {raw(farm=CSV_FARM)} SELECT * FROM raw",
        "scan_csv_quoted": quoted(),
        "batch_layouts": layouts(),
        "schema_check_failures": failing("source_file, valid, missing"),
        "skipped_at_load": failing("source_file, stage, reason") + " AND reason IS NOT NULL",
        "na_tokens": na_tokens(),
        "load_counts": f"{file_rows}, CAST(5 AS BIGINT) AS columns FROM raw GROUP BY 1",
        "schema_check": f"{file_rows}, true AS valid, '' AS missing FROM raw GROUP BY 1",
        "batch_union": clean(CSV_FARM),
        "skipped_files": skipped(),
        "report_bundle": trend(f"{csv_clean_scada()}, {monthly('clean')}, {daily('clean')}"),
        "report_clean_data": of_report(f"WITH {SCADA} SELECT {headers(CLEAN_COLUMNS)} FROM scada"),
        "report_headline": of_report(headline()),
        "report_narrative": of_report(narrative()),
        "report_statistics": of_report(DESCRIBE),
        "report_power_curve": of_report(f"WITH {RATIOS} SELECT {headers(EFFICIENCY_COLUMNS)} FROM ratios"),
        "report_wind_bins": of_report(f"WITH {SCADA}, {OBSERVED_BINS} {BIN_COLUMNS}"),
        "report_charts": of_report(f"""WITH {SCADA}, {monthly()}, {daily()}
SELECT period_start, strftime(period_start, '%b %Y') AS label, active_power FROM monthly
UNION ALL SELECT period_start, 'day', active_power FROM daily"""),
        "report_quality_log": quality_log(only=(
            'SELECT "column", issue_type, CAST(row_count AS BIGINT) AS row_count, action_taken FROM log'
        )),
        "dedup_rows": f"WITH {raw()}, {DISTINCT}, {typed('distinct_rows')} SELECT * FROM typed",
        "dedup_spellings": spellings(),
        "duplicate_count": f"""WITH {raw()}, {DISTINCT}
SELECT source_file, b.n AS rows_in, d.n AS rows_distinct, b.n - d.n AS row_count
FROM (SELECT source_file, count(*) n FROM raw GROUP BY 1) b
JOIN (SELECT source_file, count(*) n FROM distinct_rows GROUP BY 1) d USING (source_file)""",
        "coerce_numeric": f"WITH {raw()}, {typed('raw')} SELECT * FROM typed",
        "coercion_counts": f"WITH {raw()}, {typed('raw')}\n" + "\nUNION ALL\n".join(
            f"SELECT source_file, '{m}' AS \"column\", count(*) FILTER ({m}_invalid) AS row_count"
            " FROM typed GROUP BY 1" for m in METRICS
        ),
        "drop_critical": f"WITH {raw()}, {typed('raw')}, {KEPT} SELECT * FROM kept",
        "null_counts": f"WITH {raw()}, {typed('raw')}\n{null_counts('typed')}",
        "median_fill": f"""WITH {raw()}, {typed('raw')}, {KEPT}, {MEDIANS}
SELECT k.source_file, date_time, active_power, {FILLED_COLUMNS}
FROM kept k JOIN medians m USING (source_file)""",
        "median_by_brackets": f"WITH {raw()}, {typed('raw')}, {KEPT}, {MEDIANS} SELECT * FROM medians",
        "parse_ts_strict": parsed_dates(PLAIN_DATES),
        "parse_ts_fallback": parsed_dates(MIXED_DATES),
        "parse_ts_forms": """
SELECT l_orderkey, l_linenumber, CASE l_orderkey % 8
    WHEN 4 THEN date_trunc('hour', moment) WHEN 7 THEN date_trunc('day', moment) ELSE moment
  END AS date_time, 'flexible' AS date_format
FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_orderkey % 24 AS INT))
        + to_minutes(CAST(l_linenumber * 7 AS INT)) AS moment FROM lineitem)""",
        "clean_table": clean(FARM),
        "clean_table_salted": clean(FARM),
        "clean_counts": f"""WITH {raw()}, {DISTINCT}, {typed('distinct_rows')}, {KEPT}
SELECT source_file, b.n AS rows_in, k.n AS rows_out, b.n - k.n AS dropped
FROM (SELECT source_file, count(*) n FROM raw GROUP BY 1) b
JOIN (SELECT source_file, count(*) n FROM kept GROUP BY 1) k USING (source_file)""",
        "quality_log": quality_log(MIXED_DATES),
        "quality_log_for_run": quality_log(only=(
            'SELECT "column", issue_type, CAST(row_count AS BIGINT) AS row_count, action_taken'
            " FROM log WHERE source_file = (SELECT max(source_file) FROM log)"
        )),
        "describe_stats": DESCRIBE,
        "describe_by_brackets": DESCRIBE,
        "operational_rows": f"WITH {OPERATIONAL} SELECT * FROM operational",
        "efficiency_excluded": f"""WITH {SCADA}
SELECT count(*) AS total_rows,
  count(*) FILTER (theoretical_power > 0 AND active_power > 0) AS operational_rows,
  count(*) FILTER (NOT (theoretical_power > 0 AND active_power > 0)) AS excluded_rows
FROM scada""",
        "efficiency": f"WITH {RATIOS} SELECT * FROM ratios",
        "monthly_mean": f"WITH {SCADA}, {monthly()} {PERIODS} monthly",
        "monthly_mean_gaps": f"WITH {SPARSE}, {monthly('sparse')} {PERIODS} monthly",
        "daily_total": f"WITH {SCADA}, {daily()} {PERIODS} daily",
        "daily_total_gaps": f"WITH {SPARSE}, {daily('sparse')} {PERIODS} daily",
        "hourly_mean": f"WITH {SCADA}, {HOURLY} {PERIODS} hourly",
        "mean_daily_yield": f"""WITH {SCADA}, {daily()}
SELECT CAST(date_trunc('month', period_start) AS TIMESTAMP) AS period_start,
  avg(active_power) AS mean_daily_total FROM daily GROUP BY 1""",
        "wind_bins": f"WITH {SCADA}, {OBSERVED_BINS} {BIN_COLUMNS}",
        "compass_bins": f"WITH {SCADA}, {COMPASS_BINS} {BIN_COLUMNS}",
        "dominant_direction": f"WITH {SCADA}, {OBSERVED_BINS} {BIN_COLUMNS} ORDER BY count DESC, bin_index LIMIT 1",
        "mean_efficiency_pct": f"""WITH {OPERATIONAL}
SELECT round(avg(active_power / theoretical_power) * 100, 6) AS mean_efficiency_pct FROM operational""",
        "operational_hours": f"""WITH {OPERATIONAL}
SELECT CAST(round_even(count(*) * 10 / 60, 0) AS BIGINT) AS operational_hours FROM operational""",
        "peak_month": f"""WITH {SCADA}, {monthly()}, {PEAK}
SELECT period_start, active_power, month_label FROM peak""",
        "headline_stats": headline(),
        "narrative": narrative(),
        "preview_efficiency": f"""WITH {RATIOS} SELECT * FROM ratios
ORDER BY date_time, active_power, wind_speed, theoretical_power LIMIT 5""",
        "clean_data_sheet": f"WITH {SCADA} SELECT {headers(CLEAN_COLUMNS)} FROM scada",
        "power_curve_sheet": f"WITH {RATIOS} SELECT {headers(EFFICIENCY_COLUMNS)} FROM ratios",
        "trend_sheet": trend(f"{SCADA}, {monthly()}, {daily()}"),
        "chart_power_trend": f"WITH {SCADA}, {daily()} {PERIODS} daily",
        "chart_scatter": f"WITH {OPERATIONAL} SELECT wind_speed, active_power FROM operational",
        "chart_scatter_density": f"""WITH {OPERATIONAL}
SELECT CAST(floor(wind_speed / 0.1::DOUBLE) AS BIGINT) AS speed_cell,
  CAST(floor(active_power / 10) AS BIGINT) AS power_cell, count(*) AS points
FROM operational GROUP BY 1, 2""",
        "chart_theoretical_curve": f"WITH {OPERATIONAL} SELECT wind_speed, date_time, theoretical_power FROM operational",
        "chart_monthly_bar": f"""WITH {SCADA}, {monthly()}
SELECT period_start, strftime(period_start, '%b %Y') AS label,
  active_power FROM monthly""",
    }
