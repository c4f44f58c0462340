"""Scalar functions on the fixture values."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import levels, parsing, seasonal, text
from gaugeworks.operators import columns as cols


def one(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


@pytest.mark.parametrize(
    "row, status",
    [
        ((10.0, 12.0, 18.0, 25.0), "NORMAL"),
        ((15.0, 12.0, 18.0, 25.0), "WARNING"),
        ((20.0, 12.0, 18.0, 25.0), "DANGER"),
        ((30.0, 12.0, 18.0, 25.0), "HIGH_FLOOD_EXCEEDED"),
        ((12.0, 12.0, 18.0, 25.0), "WARNING"),
        ((18.0, 12.0, 18.0, 25.0), "DANGER"),
        ((25.0, 12.0, 18.0, 25.0), "HIGH_FLOOD_EXCEEDED"),
        ((None, 12.0, 18.0, 25.0), None),
        ((10.0, None, None, None), None),
        ((15.0, None, None, None), None),
        ((30.0, None, None, 25.0), "HIGH_FLOOD_EXCEEDED"),
        ((465.5, 463.91, 465.5, 465.5), "HIGH_FLOOD_EXCEEDED"),
    ],
)
def test_flood_status(spark, row, status):
    df = one(spark, "l double, w double, d double, h double", row)
    assert df.select(levels.flood_status(*[F.col(c) for c in "lwdh"])).first()[0] == status


@pytest.mark.parametrize("level, alert", [(6100.0, True), (6000.0, False), (None, False)])
def test_flood_alert(spark, level, alert):
    assert one(spark, "l double", (level,)).select(levels.flood_alert(F.col("l"))).first()[0] is alert


def test_level_band(spark):
    df = one(spark, "w double, d double, h double", (437.2, 437.8, 439.405), (0.0, None, -1.0), (None, 20.0, None))
    low, high = levels.level_band(F.col("w"), F.col("d"), F.col("h"))
    bands = [tuple(r) for r in df.select(low, high).collect()]
    assert bands[0] == pytest.approx((218.6, 703.048))
    assert bands[1] == (None, None)
    assert bands[2] == (10.0, 32.0)


def test_clip_to_band(spark):
    df = one(spark, "v double, lo double, hi double", (5.0, 10.0, 20.0), (25.0, 10.0, 20.0), (25.0, None, None), (None, 1.0, 2.0))
    clipped = df.select(levels.clip_to_band(F.col("v"), F.col("lo"), F.col("hi"))).collect()
    assert [r[0] for r in clipped] == [10.0, 20.0, 25.0, None]


@pytest.mark.parametrize(
    "status, colour",
    [("HIGH_FLOOD_EXCEEDED", "#d62728"), (" normal ", "#2ca02c"), ("bogus", "#7f7f7f"), (None, "#7f7f7f")],
)
def test_status_colour(spark, status, colour):
    assert one(spark, "s string", (status,)).select(levels.status_colour(F.col("s"))).first()[0] == colour


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("13-01-2026 10:30", datetime(2026, 1, 13, 5, 0)),
        ("3-2-2026 5:00", datetime(2026, 2, 2, 23, 30)),
        ("2026-02-03T05:00:00", datetime(2026, 2, 2, 23, 30)),
        ("2026-02-03 05:00", datetime(2026, 2, 2, 23, 30)),
        ("03/02/2026 05:00", datetime(2026, 2, 2, 23, 30)),
        ("2026-02-03T05:00:00Z", datetime(2026, 2, 3, 5, 0)),
        ("2026-02-03T05:00:00+02:00", datetime(2026, 2, 3, 3, 0)),
        ("2026-02-03T05:00:00+0200", datetime(2026, 2, 3, 3, 0)),
        ("  13-01-2026 10:30 ", datetime(2026, 1, 13, 5, 0)),
        ("31-02-2026 10:30", None),
        ("not a date", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_utc(spark, raw, expected):
    df = one(spark, "t string", (raw,))
    parsed = df.select(parsing.parse_utc(F.col("t"), "Asia/Kolkata").cast("timestamp_ntz")).first()[0]
    assert parsed == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("5800.0", 5800.0), (" 5900 ", 5900.0), ("1e3", 1000.0), (".5", 0.5), ("-2.", -2.0), ("N/A", None),
     ("1.0f", None), ("1d", None), ("nan", None), ("inf", None), ("1e999", None), (None, None)],
)
def test_to_double(spark, raw, expected):
    assert one(spark, "t string", (raw,)).select(parsing.to_double(F.col("t"))).first()[0] == expected


def test_non_finite_numbers_are_missing(spark):
    df = one(spark, "v double", (float("nan"),), (float("inf"),), (1.5,))
    assert [r[0] for r in cols.coerce_doubles(df, ["v"]).collect()] == [None, None, 1.5]


def test_days(spark):
    df = one(spark, "d string", ("2026-01-15",), ("16-01-2026",), ("not a date",), (None,), ("2026-01-15T23:30:00",))
    days = [r[0] for r in df.select(parsing.to_day(F.col("d"))).collect()]
    assert days == [date(2026, 1, 15), date(2026, 1, 16), None, None, date(2026, 1, 15)]


def test_reading_key(spark):
    df = one(spark, "c string, t timestamp, l double", ("CAVMSI", datetime(2026, 1, 13, 5), 82.5), (None, None, None))
    keys = [r[0] for r in df.select(text.reading_key(F.col("c"), F.col("t"), F.col("l"))).collect()]
    assert keys == ["CAVMSI_2026-01-13T05:00:00+0000_82.5000", "__"]


@pytest.mark.parametrize("value", [1.00005, 2.00015, 0.00015, 82.11505, 0.00105, 1234567.00005, -0.00004, 1e-9, 703.048])
def test_key_digits_match_printf(spark, value):
    assert one(spark, "v double", (value,)).select(text.fixed(F.col("v"), 4)).first()[0] == f"{value:.4f}"


def test_daily_key(spark):
    df = one(spark, "s string, d date, v bigint", ("F700000109", date(2026, 1, 15), 5800), ("F700000110", None, None))
    keys = [r[0] for r in df.select(text.daily_key(F.col("s"), F.col("d"), F.col("v"))).collect()]
    assert keys == ["F700000109_2026-01-15_5800.0", "F700000110__"]


def test_clean_name(spark):
    df = one(spark, "n string", ("  Old   Delhi\tRailway  Bridge ",))
    assert df.select(text.clean_name(F.col("n"))).first()[0] == "old delhi railway bridge"


def test_seasonal(spark):
    df = one(spark, "t timestamp", (datetime(2026, 1, 1, 6),))
    row = df.select(*[c.alias(n) for n, c in seasonal.seasonal_encodings(F.col("t")).items()]).first()
    assert row["sin_hour"] == pytest.approx(1.0)
    assert row["cos_hour"] == pytest.approx(0.0, abs=1e-12)
    assert row["sin_doy"] == pytest.approx(0.017202, abs=1e-5)


def test_normalize_columns_coalesces_in_input_order(spark):
    df = one(
        spark,
        "`Station ` string, `River Water Level Telemetry Hourly (meter)` string, level string, SlNo int, `LAT` double",
        ("MUSIRI", None, "82.5", 1, 10.9),
        ("MUSIRI", "81.0", "82.5", 2, 10.9),
    )
    out = cols.normalize_columns(df)
    assert out.columns == ["station_name", "water_level", "latitude", "SlNo"]
    assert [r["water_level"] for r in out.collect()] == ["82.5", "81.0"]


def test_column_order_and_projection(spark):
    df = one(spark, "extra int, water_level double, station_code string", (1, 2.0, "A"))
    assert cols.order_columns(df).columns == ["station_code", "water_level", "extra"]
    assert cols.canonical(df).columns == ["station_code", "water_level"]


def test_type_inference_reads_all_rows(spark):
    rows = [("2026-01-15", "5800", "2000", "a")] * 20 + [("16-01-2026", "5.5", "17", "2026-01-01"), (None, None, None, None)]
    df = one(spark, "day string, number string, year string, mixed string", *rows)
    assert cols.infer_text_types(df) == {"day": "date", "number": "double", "year": "double", "mixed": "string"}


def test_untimed_rows_are_dropped_and_counted(spark):
    from pyspark.sql import Observation

    seen = Observation("dropped")
    df = one(spark, "timestamp timestamp, v int", (None, 1), (datetime(2026, 1, 1), 2))
    assert [r["v"] for r in cols.drop_untimed(df, report=seen).collect()] == [2]
    assert seen.get == {"dropped_rows": 1}
