"""CSV sources, the audit log, the report and the two kinds of run."""

from datetime import date
from pathlib import Path

import pytest
from conftest import GOLDEN, HEADER, scan_one, write_csv
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.errors import ReportError
from anemoscope.plans import jobs
from anemoscope.plans.report import ReportOptions
from anemoscope.sources import bundle, csv_scan, quality_log

REORDER = [3, 0, 4, 1, 2]


def reordered(text):
    return "\n".join(",".join(line.split(",")[i] for i in REORDER) for line in text.splitlines())


def options(tmp_path, **more):
    report = ReportOptions(
        str(tmp_path / "out"), more.pop("fmt", "parquet"), more.pop("sort_rows", False),
        date(2026, 5, 20),
    )
    return jobs.JobOptions(report, str(tmp_path / "log"), **more)


def test_scan_keeps_text_and_counts_columns(spark, golden):
    scan = scan_one(spark, golden)
    assert scan.columns == {"golden.csv": 5}
    types = dict(scan.rows.drop(csv_scan.TOO_LONG).dtypes)
    assert set(types.values()) == {"string"}
    assert scan.rows.columns[0] == "source_file"


def test_short_rows_are_padded_and_long_rows_found(spark, tmp_path):
    rows = "2018-01-01 00:00:00,1,2,3\n2018-01-01 00:10:00,1,2,3,4\n"
    short = scan_one(spark, write_csv(tmp_path / "short.csv", rows)).rows
    assert short.filter("wind_direction IS NULL AND NOT row_too_long").count() == 1
    long_rows = rows + "2018-01-01 00:20:00,1,2,3,4,\n" + '"a,b",1,2,3,4\n'
    long = scan_one(spark, write_csv(tmp_path / "long.csv", long_rows)).rows
    assert len(long.filter("row_too_long").collect()) == 1


def test_odd_file_names_and_folders_of_parts(spark, tmp_path):
    folder = tmp_path / "in"
    names = ["a b+c%20.csv", "[x]{y}.csv", "parts.csv"]
    for name in names[:2]:
        write_csv(folder / name, GOLDEN)
    write_csv(folder / "parts.csv" / "part-0.csv", GOLDEN)
    write_csv(folder / "parts.csv" / "part-1.csv", reordered(GOLDEN), reordered(HEADER))
    (folder / "parts.csv" / "_SUCCESS").write_text("")
    (folder / "notes.txt").write_text("x")
    scan = csv_scan.scan(spark, csv_scan.list_sources(spark, str(folder)))
    counts = {r.source_file: r["count"] for r in scan.rows.groupBy("source_file").count().collect()}
    assert counts == {names[0]: 12, names[1]: 12, names[2]: 24}


def test_column_names():
    assert csv_scan.column_names(("Date/Time", "x", "X", "", "wind_speed")) == [
        "date_time", "x", "X.1", "Unnamed: 3", "wind_speed.1",
    ]


def test_schema_message():
    assert csv_scan.schema_message(tuple(HEADER.split(","))) is None
    message = csv_scan.schema_message(("Date/Time", "bad"))
    assert message.startswith("Error: Schema validation failed.\nMissing columns: ['LV ActivePower (kW)'")
    assert "Expected columns: ['Date/Time', " in message


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(ReportError, match="File not found"):
        jobs.run_single(spark, str(tmp_path / "no.csv"), options(tmp_path))
    with pytest.raises(ReportError, match="Folder not found"):
        jobs.run_batch(spark, str(tmp_path / "no"), options(tmp_path))
    (tmp_path / "empty").mkdir()
    with pytest.raises(ReportError, match="No .csv files found"):
        jobs.run_batch(spark, str(tmp_path / "empty"), options(tmp_path))


def test_unusable_single_files(spark, tmp_path):
    empty = tmp_path / "in" / "empty.csv"
    empty.parent.mkdir()
    empty.write_text("\n \n")
    with pytest.raises(ReportError, match="No columns to parse"):
        jobs.run_single(spark, str(empty), options(tmp_path))
    missing = write_csv(tmp_path / "in" / "missing.csv", "1,2\n", "Date/Time,x")
    with pytest.raises(ReportError, match="Missing columns"):
        jobs.run_single(spark, missing, options(tmp_path))
    long = write_csv(tmp_path / "in" / "long.csv", "2018-01-01 00:00:00,1,2,3,4,5\n")
    with pytest.raises(ReportError, match="more fields"):
        jobs.run_single(spark, long, options(tmp_path))
    assert not (tmp_path / "log").exists()
    dates = write_csv(tmp_path / "in" / "dates.csv", "xx,1,2,3,4\n")
    with pytest.raises(ReportError, match="Could not parse date column"):
        jobs.run_single(spark, dates, options(tmp_path))
    assert quality_log.read(spark, str(tmp_path / "log")).count() == 10


def test_single_run(spark, golden, tmp_path, capsys):
    before = Path(golden).read_bytes()
    first = jobs.run_single(spark, golden, options(tmp_path, preview=True))
    second = jobs.run_single(spark, golden, options(tmp_path, sort_rows=True))
    assert Path(golden).read_bytes() == before
    assert first.report_path.endswith("report_2026-05-20")
    assert second.report_path.endswith("report_2026-05-20_1")
    for name in config.REPORT_MEMBERS:
        assert (Path(first.report_path) / name).is_dir()
    clean = spark.read.parquet(f"{first.report_path}/clean_data")
    assert clean.columns[0] == "Timestamp" and clean.count() == 8
    curve = spark.read.parquet(f"{first.report_path}/power_curve_analysis")
    assert curve.columns[-1] == "Efficiency Ratio" and curve.count() == 6
    log = str(tmp_path / "log")
    assert quality_log.read(spark, log).count() == 22
    own = quality_log.read(spark, log, second.last_run_id)
    assert own.count() == 11 and own.columns == config.LOG_FIELDS
    member = spark.read.parquet(f"{second.report_path}/data_quality_log")
    assert sorted(member.collect()) == sorted(own.collect())
    printed = capsys.readouterr().out
    assert "[LOAD] 12 rows × 5 columns" in printed
    assert "[CLEAN] 12 rows in → 8 rows clean (4 dropped)" in printed
    assert "[ANALYSE] 2 rows excluded from efficiency (zero theoretical or non-positive output)" in printed
    assert "--- daily (64 rows) ---" in printed


def test_csv_report(spark, golden, tmp_path):
    result = jobs.run_single(spark, golden, options(tmp_path, fmt="csv"))
    clean = spark.read.option("header", True).csv(f"{result.report_path}/clean_data")
    assert clean.columns[1] == "Active Power (kW)" and clean.count() == 8


def test_output_inside_an_input_is_refused(spark, golden, tmp_path):
    inside = jobs.JobOptions(ReportOptions(f"{golden}/out"), str(tmp_path / "log"))
    with pytest.raises(ReportError, match="lies inside the input"):
        jobs.run_single(spark, golden, inside)


def test_claim_moves_on_when_a_name_is_taken(spark, tmp_path, monkeypatch):
    table = spark.range(1)
    bundle.claim(str(tmp_path), "clean_data", table, "parquet", date(2026, 1, 1))
    seen = bundle.storage.exists
    # Another run takes the name between the look and the write.
    monkeypatch.setattr(bundle.storage, "exists", lambda s, p: seen(s, p) and p.endswith("_9"))
    path = bundle.claim(str(tmp_path), "clean_data", table, "parquet", date(2026, 1, 1))
    assert path.endswith("report_2026-01-01_1")


@pytest.fixture
def folder(tmp_path):
    inputs = tmp_path / "in"
    write_csv(inputs / "golden.csv", GOLDEN)
    write_csv(inputs / "golden_copy.csv", GOLDEN)
    write_csv(inputs / "reordered.csv", reordered(GOLDEN), reordered(HEADER))
    write_csv(inputs / "missing_col.csv", "1,2\n", "Date/Time,x")
    write_csv(inputs / "long_row.csv", "2018-01-01 00:00:00,1,2,3,4,5\n")
    write_csv(inputs / "bad_date.csv", "xx,1,2,3,4\n")
    write_csv(inputs / "extra_col.csv", GOLDEN.replace("\n", ",7\n"), f"{HEADER},site")
    write_csv(inputs / "no_rows.csv", "")
    (inputs / "empty.csv").write_text("")
    return str(inputs)


def test_batch_run(spark, folder, tmp_path, capsys):
    result = jobs.run_batch(spark, folder, options(tmp_path, flag_skipped=True))
    clean = spark.read.parquet(f"{result.report_path}/clean_data")
    assert clean.columns[0] == "source_file"
    counts = {r.source_file: r["count"] for r in clean.groupBy("source_file").count().collect()}
    good = ["extra_col.csv", "golden.csv", "golden_copy.csv", "reordered.csv"]
    assert counts == dict.fromkeys(good, 8) and result.rows == 32
    values = ["Timestamp", *list(config.DISPLAY_HEADERS.values())[1:5]]
    rows = {g: sorted(map(str, clean.filter(F.col("source_file") == g).select(*values).collect())) for g in good}
    assert rows["reordered.csv"] == rows["golden.csv"]
    sites = {r.source_file: r.site for r in clean.select("source_file", "site").distinct().collect()}
    assert sites["extra_col.csv"] == "7" and sites["golden.csv"] is None
    log = quality_log.read(spark, str(tmp_path / "log"))
    assert log.count() == 5 * 11 + 10 + 2  # two skipped files are flagged
    assert log.select("run_id").distinct().count() == 7
    last = quality_log.read(spark, str(tmp_path / "log"), result.last_run_id)
    assert last.count() == 11
    printed = capsys.readouterr().out
    assert "[BATCH] Found 9 CSV file(s)" in printed
    assert "[SKIP] missing_col.csv — Error: Schema validation failed." in printed
    assert "[SKIP] empty.csv — Error: Could not read file" in printed
    assert "[SKIP] long_row.csv — Error: Could not read file" in printed
    assert "[SKIP] bad_date.csv — Error: Could not parse date column" in printed
    assert "[BATCH] Consolidated: 32 total rows" in printed


def test_batch_without_a_good_file(spark, tmp_path):
    write_csv(tmp_path / "in" / "bad_date.csv", "xx,1,2,3,4\n")
    with pytest.raises(ReportError, match="No files were successfully processed"):
        jobs.run_batch(spark, str(tmp_path / "in"), options(tmp_path))
    assert quality_log.read(spark, str(tmp_path / "log")).count() == 10


def test_log_is_pruned_by_run_date(spark, golden, tmp_path):
    jobs.run_single(spark, golden, options(tmp_path))
    read = quality_log.read(spark, str(tmp_path / "log"), "x", date(2020, 1, 1))
    assert "PartitionFilters: [isnotnull(run_date" in read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 0


@pytest.mark.parametrize(
    "arguments, message",
    [([], config.NO_INPUT), (["--file", "a", "--folder", "b"], config.BOTH_INPUTS)],
)
def test_argument_rules(arguments, message):
    with pytest.raises(SystemExit) as stop:
        jobs.main(arguments)
    assert stop.value.code == message


def test_default_arguments():
    chosen = jobs.parse_arguments(["--file", "a.csv"])
    assert chosen.output == "output" and chosen.format == "parquet"


def test_unforeseen_failures_become_one_message(spark, golden, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "clean", lambda *a, **k: 1 / 0)
    with pytest.raises(ReportError, match="Unexpected error during cleaning: division by zero"):
        jobs.run_single(spark, golden, options(tmp_path))


EXTRAS = HEADER + ",Timestamp,wind_speed_median,__low0,Active Power (kW),efficiency_ratio"


def with_extras(rows):
    lines = [line for line in rows.splitlines() if line]
    return "".join(f"{line},t{n},m{n},l{n},a{n},e{n}\n" for n, line in enumerate(lines))


def test_bad_files_and_clashing_columns_cost_one_file_at_most(spark, tmp_path):
    folder = tmp_path / "in"
    write_csv(folder / "extras.csv", with_extras(GOLDEN), EXTRAS)
    write_csv(folder / "good.csv", GOLDEN)
    (folder / "parts.csv").mkdir()
    broken = Path(write_csv(folder / "broken.csv", GOLDEN))
    (folder / ".broken.csv.crc").write_bytes(b"crc\0\0\0\2\0" + b"\1" * 8)
    assert broken.exists()
    result = jobs.run_batch(spark, str(folder), options(tmp_path))
    clean = spark.read.parquet(f"{result.report_path}/clean_data")
    assert {"Timestamp", "Timestamp.1", "Active Power (kW).1", "wind_speed_median.1"} <= set(clean.columns)
    assert {r.source_file for r in clean.select("source_file").distinct().collect()} == {
        "extras.csv", "good.csv"
    }
    shown = clean.where("source_file = 'extras.csv'").select("`Timestamp.1`").collect()
    assert {r[0][0] for r in shown} == {"t"}


def test_problems_of_unreadable_parts(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "none.csv").mkdir(parents=True)
    write_csv(folder / "broken.csv", GOLDEN)
    (folder / ".broken.csv.crc").write_bytes(b"crc\0\0\0\2\0" + b"\1" * 8)
    write_csv(folder / "good.csv", GOLDEN)
    scan = csv_scan.scan(spark, csv_scan.list_sources(spark, str(folder)))
    assert set(scan.rejected) == {"broken.csv", "none.csv"}
    assert all(r.startswith("Error: Could not read file") for r in scan.rejected.values())
    assert "Checksum" in scan.rejected["broken.csv"]
    assert scan.rows.count() == GOLDEN.count("\n")


@pytest.mark.parametrize("inside", ["input", "report", "output"])
def test_log_stays_out_of_inputs_and_reports(spark, tmp_path, inside):
    path = write_csv(tmp_path / "in" / "a.csv", GOLDEN)
    places = {
        "input": f"{path}/log", "report": f"{tmp_path}/out/report_2026-05-20/log",
        "output": f"{tmp_path}/out",
    }
    with pytest.raises(ReportError, match="path"):
        bundle.check_output(spark, [path], f"{tmp_path}/out", places[inside])
    bundle.check_output(spark, [path], f"{tmp_path}/out", f"{tmp_path}/out/log")


@pytest.mark.parametrize("text, moment", [
    ("1/2/2018 1:10:00 PM", "2018-01-02 13:10:00"), ("1/2/2018 12:10 am", "2018-01-02 00:10:00"),
    ("01/02/18 00:10", "2018-01-02 00:10:00"), ("13/02/99", "1999-02-13 00:00:00"),
    ("02 Jan 2018 00:10", "2018-01-02 00:10:00"), ("02-Jan-2018 00:10:00", "2018-01-02 00:10:00"),
    ("January 2, 2018 3 PM", "2018-01-02 15:00:00"), ("Sept 5 2018", "2018-09-05 00:00:00"),
    ("20180102 00:10:00", "2018-01-02 00:10:00"), ("201801020010", "2018-01-02 00:10:00"),
    ("20180102", "2018-01-02 00:00:00"), ("2018-01-02 10", "2018-01-02 10:00:00"),
    ("1/2/2018 13:10 PM", None), ("31 Feb 2018", None), ("Janus 2 2018", None), ("2018", None),
])
def test_common_date_forms(spark, text, moment):
    from anemoscope.operators.cleaning import parse_dates

    table = spark.createDataFrame([(text,)], "date_time string")
    found = parse_dates(table).first()
    assert (found.date_time and str(found.date_time)) == moment


MORE_FORMS = [
    ("Mayuary 5, 2018", None), ("5 Junember 2018", None), ("Tues 2 Jan 2018", None), ("Mon", None),
    ("Mon, 01 Jan 2018 00:10", "2018-01-01 00:10:00"), ("Monday 01 January 2018", "2018-01-01 00:00:00"),
    ("Mon 2018-01-01 00:10", "2018-01-01 00:10:00"), ("2018-01-02 Tue 03:04", "2018-01-02 03:04:00"),
    ("Mon Jan  1 00:10:00 2018", "2018-01-01 00:10:00"), ("Jan 1 2018 Mon", "2018-01-01 00:00:00"),
    ("Tue 02/01/2018", "2018-02-01 00:00:00"), ("Sun, Jan 5, 2018 3 PM", "2018-01-05 15:00:00"),
    ("2018 Jan 5", "2018-01-05 00:00:00"), ("2018-Jan-05 10:00", "2018-01-05 10:00:00"),
    ("99 Jan 05", "1999-01-05 00:00:00"), ("5 Jan 18", "2018-01-05 00:00:00"), ("Jan 2018", "2018-01-01 00:00:00"),
    ("2018-01", "2018-01-01 00:00:00"), ("18-01-02", "2002-01-18 00:00:00"), ("99-01-02", "1999-01-02 00:00:00"),
    ("32/01/02 03:04", "2032-01-02 03:04:00"), ("45.1.2", "2045-01-02 00:00:00"), ("99/13/02", None),
    ("99-1-2 5 pm", "1999-01-02 17:00:00"), ("2018-W01-1", None), ("2018-001", None),
]


def test_more_date_forms(spark):
    from anemoscope.operators.cleaning import parse_dates

    table = spark.createDataFrame([(text,) for text, _ in MORE_FORMS], "text string")
    found = parse_dates(table.withColumn("date_time", F.col("text"))).collect()
    found = {row.text: row.date_time and str(row.date_time) for row in found}
    assert found == dict(MORE_FORMS)


def test_an_interrupted_append_is_repeated_whole(spark, golden, tmp_path, monkeypatch):
    from conftest import clean_one

    path = str(tmp_path / "log")
    first, second = clean_one(spark, golden).quality_log, clean_one(spark, golden).quality_log
    quality_log.append(first, path)
    with monkeypatch.context() as patch:
        patch.setattr(quality_log, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            quality_log.append(second, path)
    assert quality_log.read(spark, path).count() == 11  # written but not committed
    for _ in range(2):
        quality_log.append(second, path)
        assert quality_log.read(spark, path).count() == 22
    run = second.first()["run_id"]
    assert quality_log.read(spark, path, run).count() == 11


def test_groups_get_salts_by_their_weight(spark, monkeypatch):
    from anemoscope.operators.lookup import attach

    rows = spark.range(3_000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.range(5).select(F.lit(2).alias("k"), F.col("id").alias("v")))
    lookup = spark.createDataFrame([(0, "a", 2_000), (1, "b", 1_000), (2, "c", 5)], "k int, name string, n bigint")
    expected = sorted(map(tuple, rows.join(lookup.drop("n"), "k").collect()))
    monkeypatch.setattr(config, "BROADCAST_ROWS", 2)
    for per_salt in (1, 300, 10_000):
        found = attach(rows, lookup, ["k"], "inner", 3, "n", per_salt)
        assert found.columns == ["k", "v", "name"]
        assert sorted(map(tuple, found.collect())) == expected
    semi = attach(rows, lookup.where("k < 2"), ["k"], "left_semi", 3, "n", 300)
    assert semi.columns == ["k", "v"] and semi.count() == 3_000


def test_lines_of_a_farm_make_bounded_part_files(spark, tmp_path, monkeypatch):
    from anemoscope.plans import adapter
    from anemoscope.sources import csv_scan

    spark.range(4_000).selectExpr("id AS l_orderkey").write.parquet(str(tmp_path / "lineitem.parquet"))

    def view(spark, sf_dir):
        rows = adapter.lineitem(spark, sf_dir).selectExpr(
            "concat('farm_', l_orderkey % 4) AS source_file", "concat('2018-01-01 00:00:00,', l_orderkey, ',2,3,4') AS line"
        )
        return adapter._with_headers(rows, dict.fromkeys(range(4), adapter._header(adapter.STANDARD)))

    monkeypatch.setattr(adapter, "BYTES_PER_PART", 1_500)
    folder = adapter.line_folder(spark, str(tmp_path), view)
    parts = sorted((tmp_path / folder).glob("farm=0.csv/part-*"))
    assert len(parts) > 2
    assert max(len(p.read_text().splitlines()) for p in parts) < 900
    found = csv_scan.scan(spark, csv_scan.list_sources(spark, folder))
    assert found.rows.count() == 4_000 and not found.rejected
    assert found.rows.select("active_power").distinct().count() == 4_000


def test_a_failure_of_the_medians_is_one_of_the_cleaning(spark, golden, tmp_path, monkeypatch):
    from anemoscope.operators import cleaning

    def fail(*args, **options):
        raise ValueError("no medians")

    monkeypatch.setattr(cleaning, "file_medians", fail)
    options = jobs.JobOptions(jobs.ReportOptions(str(tmp_path / "out")), str(tmp_path / "log"))
    for run, path in ((jobs.run_single, golden), (jobs.run_batch, str(tmp_path / "in"))):
        with pytest.raises(ReportError, match="during cleaning: no medians"):
            run(spark, path, options)
