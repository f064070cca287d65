"""Lines, records, headers and broken files of CSV sources."""

import csv
import random
import struct
import time
import zlib
from pathlib import Path

import pytest
from conftest import GOLDEN, HEADER, scan_one, write_csv
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.plans import jobs
from anemoscope.sources import csv_scan, records
from anemoscope.sources.storage import Workspace
from tests.test_sources_and_jobs import options

NOTES = f"{HEADER},note"


def scan_folder(spark, folder):
    return csv_scan.scan(spark, csv_scan.list_sources(spark, str(folder)))


def small_splits(spark, size=64):
    """A session that cuts files into splits of a few bytes."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", size)
    session.conf.set("spark.sql.files.openCostInBytes", 1)
    return session


def rows_of(scan, *columns):
    names = [f"`{c}`" for c in columns] or [f"`{c}`" for c in scan.rows.columns]
    return sorted(map(tuple, scan.rows.select(*names).collect()), key=str)


# --- Fields and records ---------------------------------------------------------------


def random_record(draw):
    fields = ["".join(draw.choices('a", \n', k=draw.randint(0, 6))) for _ in range(draw.randint(1, 5))]
    return ",".join(
        '"' + f.replace('"', '""') + '"' + draw.choice(["", "", "", "x", 'y"'])
        if "\n" in f or "," in f or f.startswith('"') or draw.random() < 0.4 else f
        for f in fields
    )


def test_fields_as_the_csv_module_cuts_them(spark):
    draw = random.Random(1)
    texts = [t for t in (random_record(draw) for _ in range(3000)) if t]
    texts += ['"""a,b"', '"""",x', '"a"",b"', 'x"y,z', '""x,"', '"a""b""",c', ",", '"",""', "a,,", '5" pipe,6" pipe']
    table = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    found = table.select("n", "t", records.fields(F.col("t")).alias("f"), records.ends_inside(F.col("t")).alias("e"))
    for row in found.collect():
        # A line feed ends a record outside quotes; such texts are cut into lines before.
        first = next(csv.reader([f"{line}\n" for line in row.t.split("\n")]))
        whole = list(csv.reader([f"{line}\n" for line in row.t.split("\n")]))
        if len(whole) == 1 and not row.e:
            assert row.f == first, row.t


def test_a_line_ends_inside_quotes_as_the_csv_module_reads_on(spark):
    draw = random.Random(2)
    lines = ["".join(draw.choices('a",', k=draw.randint(0, 9))) for _ in range(3000)]
    found = spark.createDataFrame([(t,) for t in lines], "t string").select(
        "t", records.ends_inside(F.col("t")).alias("e")
    )
    for row in found.distinct().collect():
        goes_on = len(list(csv.reader([row.t + "\n", "next\n"]))) < (2 if row.t else 1)
        assert row.e == goes_on, row.t


def quoted_rows(draw, count):
    rows = []
    for n in range(count):
        note = draw.choice([
            "plain", 'two\nlines', '\n\n', 'a "quoted", word', f'{n}\n"\n,\n', "", 'ends with"\n', "x" * 150 + "\n",
        ])
        rows.append((f"2018-01-01 00:00:{n % 60:02}", str(n), "1", "2", "3", note))
    return rows


@pytest.mark.parametrize("size, first", [(400, True), (1 << 20, False)])
def test_records_over_several_lines_and_splits(spark, tmp_path, size, first):
    draw = random.Random(size)
    rows = quoted_rows(draw, 150)
    order = [5, 0, 1, 2, 3, 4] if first else [0, 1, 2, 3, 4, 5]
    folder = tmp_path / "in"
    folder.mkdir()
    for name, part in (("a.csv", rows[:100]), ("b.csv", rows[100:])):
        with open(folder / name, "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator="\n")
            writer.writerows([NOTES.split(",")[i] for i in order] for _ in range(1))
            writer.writerows([row[i] for i in order] for row in part)
    write_csv(folder / "plain.csv", GOLDEN)
    session = small_splits(spark, size)
    scan = scan_folder(session, folder)
    assert scan.rejected == {}
    expected = sorted(((f"{'a' if n < 100 else 'b'}.csv", r[0], r[1], r[5] or None) for n, r in enumerate(rows)), key=str)
    found = [r for r in rows_of(scan, "source_file", "date_time", "active_power", "note") if r[0] != "plain.csv"]
    assert found == expected
    assert scan.rows.where("source_file = 'plain.csv'").count() == GOLDEN.count("\n")
    assert scan.rows.where(csv_scan.TOO_LONG).count() == 0


def test_lines_of_records_are_not_kept(spark, tmp_path):
    """Where all files have records over several lines, the parsed records alone stay on disk."""
    draw = random.Random(5)
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        with open(folder / name, "w", newline="", encoding="utf-8") as file:
            csv.writer(file, lineterminator="\n").writerows([NOTES.split(","), *quoted_rows(draw, 80)])
    session = small_splits(spark, 300)
    workspace = Workspace(session)
    scan = csv_scan.scan(session, csv_scan.list_sources(session, str(folder)), workspace)
    assert scan.rows.count() == 160 and scan.rejected == {}
    kept = {path.name.split("-", 1)[1] for path in Path(workspace.path).iterdir()}
    assert kept <= {"read-files", "read-again", "blocks", "records"}


def test_headers_over_two_lines_returns_and_open_quotes(spark, tmp_path):
    body = "2018-01-01 00:00:00,1,2,3,4,x\n"
    folder = tmp_path / "in"
    write_csv(folder / "two_lines.csv", body, f'{HEADER},"a\nnote"')
    write_csv(folder / "open.csv", body + '2018-01-01 00:10:00,1,2,3,4,"never closed\n' + body * 3, NOTES)
    (folder / "returns.csv").write_bytes(f"{NOTES}\r{body[:-1]}\r{body[:-1]}\r".encode())
    (folder / "windows.csv").write_bytes(f"{NOTES}\r\n\r\n{body[:-1]}\r\n  \r\n{body[:-1]}".encode())
    (folder / "marked.csv").write_bytes(b"\xef\xbb\xbf" + f"{NOTES}\n{body}".encode())
    write_csv(folder / "again.csv", f"{NOTES}\n{body}{NOTES}\n", NOTES)
    scan = scan_folder(small_splits(spark, 200), folder)
    assert set(scan.rejected) == {"open.csv"}
    assert "a quoted field is not closed" in scan.rejected["open.csv"]
    counts = {r.source_file: r["count"] for r in scan.rows.groupBy("source_file").count().collect()}
    assert counts["two_lines.csv"] == 1 and counts["marked.csv"] == 1
    assert counts["returns.csv"] == 2 and counts["windows.csv"] == 2
    headers = scan.rows.where(F.col("date_time") == "Date/Time").count()
    assert scan.rows.where("`a\nnote` = 'x'").count() == 1
    # Of a first line that the first block repeats, one is the header.
    assert (counts["again.csv"], headers) == (3, 2)


# --- Layouts ------------------------------------------------------------------------------


def test_hundred_headers_are_one_scan(spark, tmp_path):
    draw = random.Random(5)
    columns = NOTES.split(",")
    plans = {}
    for count in (1, 100):
        folder = tmp_path / str(count)
        for n in range(count):
            order = draw.sample(range(6), 6)
            values = ["2018-01-01 00:00:00", str(n), "2", "3", "4", f"note {n}"]
            write_csv(folder / f"{n}.csv", ",".join(values[i] for i in order) + "\n", ",".join(columns[i] for i in order))
        started = time.time()
        scan = scan_folder(spark, folder)
        found = rows_of(scan, "active_power", "theoretical_power", "note")
        assert time.time() - started < 30
        assert found == sorted(((str(n), "3", f"note {n}") for n in range(count)), key=str)
        plans[count] = scan.rows._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert plans[1] == plans[100]


def test_headers_of_many_files_are_read_by_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    for n in range(60):
        write_csv(folder / f"{n:03}.csv", f"2018-01-01 00:00:00,{n},2,3,4\n")
    write_csv(folder / "large.csv", "2018-01-01 00:00:00,1,2,3,4\n" * 4000)
    write_csv(folder / "lacking.csv", "1,2\n", "Date/Time,x")
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n \n")
    (folder / "none.csv").mkdir()
    write_csv(folder / "parts.csv" / "part-0", "2018-01-01 00:00:00,7,2,3,4\n")
    seen = []
    monkeypatch.setattr(csv_scan, "_lines_of", lambda s, p, f=csv_scan._lines_of: seen.append(str(p)) or f(s, p))
    many = scan_folder(spark, folder)
    assert len(seen) <= 2  # the driver looks into files without a header only
    monkeypatch.setattr(csv_scan, "FEW_FILES", 1000)
    few = scan_folder(spark, folder)
    assert rows_of(few) == rows_of(many) and many.rows.count() == 4061
    assert sorted(map(str, few.files.collect())) == sorted(map(str, many.files.collect()))
    assert set(many.rejected) == {"lacking.csv", "empty.csv", "blank.csv", "none.csv"}
    assert many.columns["large.csv"] == 5


def test_headers_of_parts_of_few_sources_start_no_tasks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    for n in range(40):
        header = HEADER + ",note" if n % 7 == 3 else HEADER
        write_csv(folder / f"{n % 3}.csv" / f"part-{n:02}", f"2018-01-01 00:00:00,{n},2,3,4\n", header)
    (folder / "0.csv" / "part-99").write_text("")
    write_csv(folder / "2.csv" / "part-98", "1,2\n", "Date/Time,x")
    asked = []
    read = csv_scan._read_headers
    monkeypatch.setattr(csv_scan, "_read_headers", lambda *a: asked.append(a) or read(*a))
    few = scan_folder(spark, folder)
    assert not asked
    monkeypatch.setattr(csv_scan, "FEW_PARTS", 0)
    many = scan_folder(spark, folder)
    assert asked
    assert rows_of(few) == rows_of(many) and few.rows.count() == 27
    assert few.columns == many.columns and few.rejected.keys() == many.rejected.keys() == {"2.csv"}


def test_two_thousand_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(2000):
        (folder / f"{n:04}.csv").write_text(f"{HEADER}\n2018-01-01 00:00:00,{n},2,3,4\n")
    sources = csv_scan.list_sources(spark, str(folder))
    assert sources.count == 2000
    workspace = csv_scan.Workspace(spark)
    csv_scan._table_of_files(spark, sources, workspace)  # starts workers
    started = time.time()
    files, seen = csv_scan._table_of_files(spark, sources, workspace)
    assert time.time() - started < 15  # a few seconds where no other test takes the cores
    assert (seen["files"], seen["bad"]) == (2000, 0)


# --- Broken files ------------------------------------------------------------------------


def with_checksums(path, broken_at):
    """Checksums of a local file that are wrong from one place on."""
    data = Path(path).read_bytes()
    sums = [zlib.crc32(data[n : n + 512]) ^ (n >= broken_at) for n in range(0, len(data), 512)]
    crc = Path(path).with_name(f".{Path(path).name}.crc")
    crc.write_bytes(b"crc\0" + struct.pack(">i", 512) + b"".join(struct.pack(">I", s) for s in sums))


def many_rows(count):
    return "".join(f"2018-01-01 00:00:00,{n},2,3,4\n" for n in range(count))


def test_a_file_that_breaks_later_costs_itself_only(spark, tmp_path):
    folder = tmp_path / "in"
    write_csv(folder / "good.csv", GOLDEN)
    with_checksums(write_csv(folder / "late.csv", many_rows(20_000)), 500_000)
    scan = scan_folder(spark, folder)
    assert set(scan.rejected) == {"late.csv"}
    assert "bytes could be read" in scan.rejected["late.csv"]
    result = jobs.run_batch(spark, str(folder), options(tmp_path))
    clean = spark.read.parquet(f"{result.report_path}/clean_data")
    assert {r[0] for r in clean.select("source_file").distinct().collect()} == {"good.csv"}


@pytest.mark.parametrize("place", ["start", "inside", "across"])
def test_bytes_that_are_not_utf8_fail_the_file(spark, tmp_path, place):
    folder = tmp_path / "in"
    write_csv(folder / "good.csv", GOLDEN)
    rows = many_rows(50).encode()
    at = {"start": 0, "inside": 700, "across": 63 * 4 - 1}[place]
    data = f"{HEADER}\n".encode() + rows
    at += 0 if place != "start" else len(HEADER.encode()) + 1
    (folder / "bad.csv").write_bytes(data[:at] + b"\xc3\x28\xff" + data[at:])
    scan = scan_folder(small_splits(spark), folder)
    assert set(scan.rejected) == {"bad.csv"}
    assert not any("�" in str(row) for row in scan.rows.collect())
    assert scan.rows.count() == GOLDEN.count("\n")


def test_clean_run_parses_sources_once(spark, golden):
    from anemoscope.operators.cleaning import clean

    plan = clean(scan_one(spark, golden).rows).table._jdf.queryExecution().optimizedPlan().toString()
    assert "csv" not in plan.lower().replace(".csv", "") and "text" not in plan.lower().split("relation")[-1][:20]


def test_missing_columns_by_raw_name():
    assert csv_scan.missing_columns(tuple(HEADER.split(","))) == []
    assert csv_scan.missing_columns(("date_time",)) == list(config.COLUMNS)
