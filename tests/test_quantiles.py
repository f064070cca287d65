"""Exact quantiles by brackets against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.operators import quantiles
from anemoscope.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]


def make_table(spark, n):
    """Groups of very different shapes; 'hot' holds most rows and many ties."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double")
    group = (
        F.when(i % 10 < 6, "hot").when(i % 10 < 8, "spread").when(i % 10 < 9, "constant")
        .otherwise("holes")
    )
    value = (
        F.when((group == "hot") & (i % 3 == 0), F.lit(0.0))
        .when(group == "hot", F.floor(noise / 1000))
        .when(group == "spread", noise - 500_000.5)
        .when(group == "constant", F.lit(7.0))
        .when(i % 20 == 9, F.exp(noise / 100_000))
    )
    return spark.range(n).select(
        "id", group.alias("g"), value.cast("double").alias("x"),
        F.when(i % 10 < 6, -noise).alias("y"),
    )


def brute_force(table, column):
    frame = table.select("g", column).toPandas()
    return {
        g: np.quantile(part.dropna(), PROBABILITIES) if part.notna().any() else None
        for g, part in frame.groupby("g")[column]
    }


@pytest.mark.parametrize("limits", ["buffer", "brackets", "narrowing", "salted"])
def test_groups(spark, monkeypatch, limits):
    table = make_table(spark, 30_000)
    if limits in ("narrowing", "salted"):
        monkeypatch.setattr(quantiles, "SMALL_BRACKET", 8)
        monkeypatch.setattr(quantiles, "PIECES", 4)
        monkeypatch.setattr(quantiles, "BRACKET_HALF_WIDTH", 0.1)
    if limits == "salted":
        monkeypatch.setattr(config, "BROADCAST_ROWS", 0)
    buffer_rows = None if limits == "buffer" else 0
    found = exact_quantiles(table, ["g"], ["x", "y"], PROBABILITIES, buffer_rows=buffer_rows)
    rows = {r.g: r for r in found.collect()}
    for column in ("x", "y"):
        for group, expected in brute_force(table, column).items():
            if expected is None:
                assert rows[group][column] is None
            else:
                np.testing.assert_allclose(rows[group][column], expected, rtol=1e-12)


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    table = make_table(spark, 5_000)
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 5)
    monkeypatch.setattr(quantiles, "BRACKET_HALF_WIDTH", 0.0)
    found = exact_quantiles(table, ["g"], ["x"], PROBABILITIES, buffer_rows=0)
    rows = {r.g: r.x for r in found.collect()}
    for group, expected in brute_force(table, "x").items():
        np.testing.assert_allclose(rows[group], expected, rtol=1e-12)


@pytest.mark.parametrize("buffer_rows", [None, 0])
def test_without_groups(spark, buffer_rows):
    table = make_table(spark, 20_000)
    found = exact_quantiles(table, [], ["x"], PROBABILITIES, buffer_rows=buffer_rows).first().x
    values = table.toPandas()["x"].dropna()
    np.testing.assert_allclose(found, np.quantile(values, PROBABILITIES), rtol=1e-12)


@pytest.mark.parametrize("buffer_rows", [None, 0])
def test_empty_table(spark, buffer_rows):
    table = make_table(spark, 0)
    assert exact_quantiles(table, ["g"], ["x"], [0.5], buffer_rows=buffer_rows).collect() == []
    assert exact_quantiles(table, [], ["x"], [0.5], buffer_rows=buffer_rows).first().x is None
