"""The golden file and the rules of each cleaning step."""

import uuid

import pytest
from conftest import GOLDEN, clean_one, scan_one, write_csv
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.numbers import number
from anemoscope.operators import cleaning

GOLDEN_LOG = [
    ("row", "duplicate", 1, "dropped"),
    ("LV ActivePower (kW)", "type_coercion", 1, "coerced"),
    ("Wind Speed (m/s)", "type_coercion", 0, "coerced"),
    ("Theoretical_Power_Curve (KWh)", "type_coercion", 0, "coerced"),
    ("Wind Direction (°)", "type_coercion", 1, "coerced"),
    ("Date/Time", "null", 1, "dropped"),
    ("LV ActivePower (kW)", "null", 2, "dropped"),
    ("Wind Speed (m/s)", "null", 1, "filled_median"),
    ("Theoretical_Power_Curve (KWh)", "null", 1, "filled_median"),
    ("Wind Direction (°)", "null", 1, "filled_median"),
    ("Date/Time", "type_coercion", 0, "coerced"),
]


def log_rows(result):
    rows = result.quality_log.orderBy("source_file", "step").collect()
    return [(r.column, r.issue_type, r.row_count, r.action_taken) for r in rows]


def test_golden_rows_and_types(spark, golden):
    result = clean_one(spark, golden)
    assert dict(result.table.dtypes) == {
        "source_file": "string", "date_time": "timestamp_ntz", "active_power": "double",
        "wind_speed": "double", "theoretical_power": "double", "wind_direction": "double",
    }
    rows = result.table.orderBy("date_time").collect()
    assert len(rows) == 8
    filled = {str(r.date_time): r for r in rows}
    assert filled["2018-01-04 00:00:00"].wind_speed == 5.7
    assert filled["2018-01-04 00:10:00"].theoretical_power == 500.0
    assert filled["2018-03-05 00:00:00"].wind_direction == 90.0
    facts = result.files.first()
    assert (facts.rows_in, facts.rows_out) == (12, 8)


def test_golden_log(spark, golden):
    result = clean_one(spark, golden)
    assert log_rows(result) == GOLDEN_LOG
    ids = {r.run_id for r in result.quality_log.collect()}
    assert len(ids) == 1
    assert uuid.UUID(ids.pop()).version == 4


def test_two_runs_have_two_ids(spark, golden):
    ids = {clean_one(spark, golden).files.first().run_id for _ in range(2)}
    assert len(ids) == 2


def test_numbers_compare_by_value_only_in_columns_of_numbers(spark, tmp_path):
    same = "2018-01-01 00:00:00,1.0,5,1,1\n2018-01-01 00:00:00,1.00,5,1,1\n"
    other = "2018-01-01 00:10:00,bad,5,1,1\n"
    numeric = clean_one(spark, write_csv(tmp_path / "a.csv", same))
    assert numeric.table.count() == 1
    mixed = clean_one(spark, write_csv(tmp_path / "b.csv", same + other))
    assert mixed.table.count() == 2


def test_extra_columns_count_in_duplicates_and_are_kept(spark, tmp_path):
    header = "id,Date/Time,LV ActivePower (kW),Wind Speed (m/s),Theoretical_Power_Curve (KWh),Wind Direction (degrees),note.x"
    row = "2018-01-01 00:00:00,1,5,1,1"
    rows = f"123456789012345678,{row},a\n123456789012345679,{row},a\n123456789012345679,{row},a\n0123456789012345679,{row},a\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows, header))
    assert "wind_direction" in result.table.columns
    kept = result.table.select("id", F.col("`note.x`").alias("note")).collect()
    assert sorted(r.id for r in kept) == ["123456789012345678", "123456789012345679"]


def test_all_null_column_stays_null_and_is_logged(spark, tmp_path):
    rows = "2018-01-01 00:00:00,1,,1,1\n2018-01-01 00:10:00,2,,1,1\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    assert [r.wind_speed for r in result.table.collect()] == [None, None]
    assert ("Wind Speed (m/s)", "null", 2, "filled_median") in log_rows(result)


def test_even_median_lies_between_the_middle_values(spark, tmp_path):
    rows = "".join(f"2018-01-01 00:0{i}:00,1,{v},1,1\n" for i, v in enumerate([4, 1, 3, 2, ""]))
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    assert result.table.filter("date_time = timestamp_ntz'2018-01-01 00:04:00'").first().wind_speed == 2.5


def test_mixed_dates(spark, tmp_path):
    rows = "02 01 2018 00:00,1,1,1,1\n13 01 2018 00:10,1,1,1,1\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    days = sorted(str(r.date_time) for r in result.table.collect())
    assert days == ["2018-01-13 00:10:00", "2018-02-01 00:00:00"]
    assert log_rows(result)[-1] == ("Date/Time", "date_parse_failure", 0, "coerced")
    dayfirst = clean_one(spark, write_csv(tmp_path / "b.csv", rows), dayfirst=True)
    days = sorted(str(r.date_time) for r in dayfirst.table.collect())
    assert days == ["2018-01-02 00:00:00", "2018-01-13 00:10:00"]


def test_unreadable_date_fails_the_file_after_ten_log_rows(spark, tmp_path):
    rows = "xx,1,1,1,1\n2018-01-01 00:00:00,1,1,1,1\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    assert result.table.count() == 0
    assert len(log_rows(result)) == 10
    facts = result.files.first()
    assert facts.stage == "clean" and "1 value(s)" in facts.reason


def test_unreadable_date_of_a_dropped_row_does_not_matter(spark, tmp_path):
    rows = "xx,,1,1,1\n2018-01-01 00:00:00,1,1,1,1\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    assert result.table.count() == 1


def test_flagged_entry_for_a_skipped_file(spark, tmp_path):
    result = clean_one(spark, write_csv(tmp_path / "a.csv", "xx,1,1,1,1\n"))
    flagged = cleaning.quality_log(result.files, flag_skipped=True)
    assert flagged.filter("action_taken = 'flagged'").count() == 1


def test_header_only_file_logs_zeros(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "")
    names = spark.createDataFrame([("a.csv",)], "source_file string")
    result = clean_one(spark, path, names=names)
    assert result.table.count() == 0
    log = log_rows(result)
    assert len(log) == 11 and {r[2] for r in log} == {0}


@pytest.mark.parametrize(
    "text, value",
    [
        ("1", 1.0), (" 1.5 ", 1.5), (".5", 0.5), ("5.", 5.0), ("-1e3", -1000.0),
        ("+2", 2.0), ("inf", float("inf")), ("-Infinity", float("-inf")),
        ("1d", None), ("1f", None), ("0x1A", None), ("1,000", None),
        ("1_000", None), ("True", None), ("", None), ("bad", None), ("1 2", None),
    ],
)
def test_number_grammar(spark, text, value):
    row = spark.range(1).select(number(F.lit(text)).alias("v")).first()
    assert row.v == value


def parse(spark, text, dayfirst=False):
    table = spark.range(1).select(F.lit(text).alias("date_time"))
    row = cleaning.parse_dates(table, dayfirst).withColumn(
        "date_time", F.col("date_time").cast("string")
    ).first()
    return row.date_time, row.date_format


@pytest.mark.parametrize(
    "text, moment, understood",
    [
        ("2018-01-02 03:04:05", "2018-01-02 03:04:05", "strict"),
        ("2018-1-2 3:4:5", "2018-01-02 03:04:05", "strict"),
        ("2018-01-02  03:04:05", "2018-01-02 03:04:05", "strict"),
        ("2018-01-02T03:04:05", "2018-01-02 03:04:05", "flexible"),
        ("2018-01-02", "2018-01-02 00:00:00", "flexible"),
        ("2018-01-02 03:04", "2018-01-02 03:04:00", "flexible"),
        (" 2018-01-02 03:04:05", "2018-01-02 03:04:05", "flexible"),
        ("2018-01-02 03:04:05.5", "2018-01-02 03:04:05.5", "flexible"),
        ("2018/01/02 03:04", "2018-01-02 03:04:00", "flexible"),
        ("2018.01.02", "2018-01-02 00:00:00", "flexible"),
        ("02/01/2018", "2018-02-01 00:00:00", "flexible"),
        ("2/1/2018 5:07", "2018-02-01 05:07:00", "flexible"),
        ("13/1/2018 05:07:09", "2018-01-13 05:07:09", "flexible"),
        ("01-02-2018 00:00:00", "2018-01-02 00:00:00", "flexible"),
        ("13.01.2018 00:00", "2018-01-13 00:00:00", "flexible"),
        ("02-01-2018T03:04", "2018-02-01 03:04:00", "flexible"),
        ("13/13/2018", None, "failed"),
        ("31 04 2018", None, "failed"),
        ("2018-02-30 00:00:00", None, "failed"),
        ("2018-01-01 24:00:00", None, "failed"),
        ("2018-13-02", None, "failed"),
        ("02 01 2018 24:00", None, "failed"),
        ("1500-01-01 00:00:00", None, "failed"),
        ("2300-01-01 00:00:00", None, "failed"),
        ("xx", None, "failed"),
    ],
)
def test_date_grammar(spark, text, moment, understood):
    assert parse(spark, text) == (moment, understood)


def test_dates_do_not_depend_on_the_session_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # Midnight of this day does not exist on that zone's clocks.
        assert parse(spark, "2018-11-04 00:00:00")[0] == "2018-11-04 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_every_na_token_is_null_and_no_coercion(spark, tmp_path):
    tokens = [t for t in config.NA_TOKENS]
    rows = "".join(f"2018-01-01 00:{i:02}:00,1,{t},1,1\n" for i, t in enumerate(tokens))
    rows += "2018-01-02 00:00:00,1,7,1,1\n2018-01-02 00:00:01,1, NA,1,1\n"
    result = clean_one(spark, write_csv(tmp_path / "a.csv", rows))
    log = log_rows(result)
    assert ("Wind Speed (m/s)", "type_coercion", 1, "coerced") in log
    assert ("Wind Speed (m/s)", "null", len(tokens) + 1, "filled_median") in log
    assert {r.wind_speed for r in result.table.collect()} == {7.0}


def test_cleaning_without_broadcast_gives_the_same_rows(spark, golden, monkeypatch):
    expected = sorted(map(str, clean_one(spark, golden).table.collect()))
    monkeypatch.setattr(config, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = clean_one(spark, golden)
        plan = result.table._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "__salt" in plan
        assert sorted(map(str, result.table.collect())) == expected
        assert log_rows(result) == GOLDEN_LOG
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_raw_scan_keeps_every_row(spark, golden):
    assert scan_one(spark, golden).rows.count() == GOLDEN.count("\n")


def test_medians_wait_until_the_rows_are_asked_for(spark, golden, monkeypatch):
    from anemoscope.operators import cleaning

    asked = []
    monkeypatch.setattr(cleaning, "file_medians", lambda *a, f=cleaning.file_medians, **k: asked.append(1) or f(*a, **k))
    result = clean_one(spark, golden)
    assert log_rows(result) == GOLDEN_LOG and not asked
    assert result.table.count() and result.table is result.table and asked == [1]


def test_groups_are_spread_without_a_broadcast(spark, monkeypatch):
    from anemoscope.operators import lookup

    monkeypatch.setattr(config, "BROADCAST_ROWS", 0)
    table = spark.createDataFrame([("a", 5_000), ("b", 10)], "k string, n bigint")
    found = {r["k"]: r["__salts"] for r in lookup._with_salts(table, "n", 1_000).collect()}
    assert found == {"a": 5, "b": 1}
