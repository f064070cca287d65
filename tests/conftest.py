import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADER = (
    "Date/Time,LV ActivePower (kW),Wind Speed (m/s),"
    "Theoretical_Power_Curve (KWh),Wind Direction (°)"
)
GOLDEN = """2018-01-01 00:00:00,380.0,5.3,400.0,0
2018-01-01 00:00:00,380.0,5.3,400.0,0
2018-01-01 00:10:00,450.5,5.7,500.0,22.5
2018-01-01 00:20:00,-2.5,2.0,0.0,45
2018-01-02 00:00:00,0,3.0,20.0,90
2018-01-02 00:10:00,bad,6.0,600.0,135
2018-01-03 12:00:00,,6.1,610.0,180
,500.0,6.2,620.0,225
2018-01-04 00:00:00,700.0,,700.0,270
2018-01-04 00:10:00,720.0,7.0,n/a,315
2018-03-05 00:00:00,900.0,8.0,1000.0,oops
2018-03-05 23:50:00,1000.0,9.0,950.0,360
"""


def write_csv(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(f"{header}\n{rows}", encoding="utf-8")
    return str(path)


@pytest.fixture
def golden(tmp_path):
    return write_csv(tmp_path / "in" / "golden.csv", GOLDEN)


def scan_one(spark, path):
    from anemoscope.sources import csv_scan

    return csv_scan.scan(spark, csv_scan.list_source(spark, path))


def clean_one(spark, path, **options):
    from anemoscope.operators.cleaning import clean

    return clean(scan_one(spark, path).rows, **options)
