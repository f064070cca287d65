"""The fused passes of a report against the operators they stand for."""

import math
import random
from datetime import datetime, timedelta

import pytest
from conftest import GOLDEN, write_csv
from pyspark.sql import functions as F

from anemoscope.operators import passes, statistics, summary, timeseries, wind
from anemoscope.plans import jobs
from anemoscope.sources import bundle
from anemoscope.sources.storage import Workspace
from tests.test_sources_and_jobs import options

SCHEMA = (
    "date_time timestamp_ntz, active_power double, wind_speed double, theoretical_power double,"
    " wind_direction double"
)


def readings(count, draw):
    start = datetime(2018, 1, 30)
    return [
        (
            start + timedelta(minutes=10 * draw.randint(0, 20_000)), draw.uniform(-50, 3000) + 1e6,
            draw.choice([None, draw.uniform(0, 25)]), draw.choice([None, 0.0, draw.uniform(0, 3000)]),
            draw.choice([None, draw.uniform(0, 360)]),
        )
        for _ in range(count)
    ]


def close(found, expected):
    assert found.columns == expected.columns
    found, expected = (sorted(map(tuple, t.collect()), key=str) for t in (found, expected))
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        for x, y in zip(a, b):
            same = x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9))
            assert same, (a, b)


@pytest.mark.parametrize("count, buffer_rows", [(0, None), (1, None), (2, 0), (700, None), (700, 0)])
def test_passes_give_what_the_operators_give(spark, count, buffer_rows):
    table = spark.createDataFrame(readings(count, random.Random(count)), SCHEMA)
    workspace = Workspace(spark)
    days = workspace.stage(passes.first_pass(table), "days")
    totals = passes.totals(days)
    moments = passes.moments(days, totals)
    described, bins = passes.second_pass(table, moments, totals, count, workspace, buffer_rows)
    close(described, statistics.describe(table))
    close(bins, wind.wind_bins(table))
    close(passes.headline_facts(moments, totals), summary.headline_facts(table))
    close(passes.monthly_mean(days), timeseries.monthly_mean(table))
    close(passes.daily_total(days), timeseries.daily_total(table))


def test_a_report_reads_the_clean_table_six_times(spark, tmp_path, monkeypatch):
    """Two passes, three members of its rows and the grid of the scatter."""
    scans = []

    def noted(table):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        scans.extend(["clean"] * plan.count("Relation [Timestamp") or [])
        return table

    write, stage, agg = bundle.write_dataset, Workspace.stage, passes.second_pass
    monkeypatch.setattr(bundle, "write_dataset", lambda t, *a: write(noted(t), *a))
    monkeypatch.setattr(Workspace, "stage", lambda self, t, label: stage(self, noted(t), label))
    seen = []
    monkeypatch.setattr(passes, "second_pass", lambda *a, **k: seen.append(1) or agg(*a, **k))
    path = write_csv(tmp_path / "in" / "golden.csv", GOLDEN)
    jobs.run_single(spark, path, options(tmp_path))
    assert (len(scans), len(seen)) == (5, 1)


def test_std_does_not_cancel(spark):
    rows = [(datetime(2018, 1, 1 + n % 3), 1e9 + n % 2, 1.0, 1.0, 1.0) for n in range(1000)]
    days = passes.first_pass(spark.createDataFrame(rows, SCHEMA))
    found = passes.moments(days, passes.totals(days)).select(F.round("std0", 9)).first()[0]
    assert found == round(math.sqrt(250 / 999), 9)
