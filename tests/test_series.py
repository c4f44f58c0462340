"""Series cleaning against plain-Python statements, with tiny and large blocks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import series as sr
from tests import brute
from tests.conftest import START


def start_hour(spark):
    return spark.range(1).select(F.floor(F.unix_timestamp(F.lit(START).cast("timestamp")) / 3600)).first()[0]


def bands_of(spark, bands: dict):
    return spark.createDataFrame(
        [(c, *b) for c, b in bands.items()], "station_code string, band_low double, band_high double"
    )


def collect(df, first):
    out = {}
    for r in df.collect():
        out.setdefault(r["station_code"], {})[r["hour"] - first] = r["level"]
    return out


def noisy(seed: int, n: int, gaps: float = 0.1, long_gap: int = 0) -> list:
    rng = random.Random(seed)
    level, out = 50.0, []
    for i in range(n):
        level += rng.gauss(0, 1)
        v = level
        if rng.random() < 0.02:
            v += rng.choice([-1, 1]) * rng.uniform(50, 500)
        if n // 3 < i < n // 3 + 80:
            v = 300 + rng.gauss(0, 5)
        out.append(None if rng.random() < gaps else round(v, 2))
    if long_gap:
        out[n // 2 : n // 2 + long_gap] = [None] * long_gap
    out[0], out[-1] = out[0] or 50.0, out[-1] or 50.0
    return out


@pytest.mark.parametrize("size", [40, 96, 2048])
def test_prepare_series_equals_brute_force(spark, hours, size):
    series = {
        "short": noisy(1, 99),
        "plain": noisy(2, 400),
        "gappy": noisy(3, 500, gaps=0.5, long_gap=120),
        "noband": noisy(4, 300),
        "end": [60.0] * 200 + [310.0 + i % 7 for i in range(70)],
        "single": [42.0],
    }
    bands = {c: (20.0, 330.0) for c in series if c != "noband"}
    got = collect(sr.prepare_series(hours(series), "seq", bands_of(spark, bands), size=size), start_hour(spark))
    for code, values in series.items():
        expected = brute.clean(values, bands.get(code))
        assert got[code].keys() == expected.keys(), code
        for i, level in expected.items():
            assert got[code][i] == pytest.approx(level, abs=1e-9), (code, i)


@pytest.mark.parametrize("size", [30, 2048])
def test_fence_grid_and_filling(spark, hours, size):
    values = noisy(5, 260, gaps=0.3, long_gap=60)
    hourly = sr.hourly_mean(hours({"a": values}))
    first = start_hour(spark)
    fenced = collect(sr.mad_fence(hourly, size=size), first)["a"]
    expected = {i: v for i, v in enumerate(brute.fence(values)) if v is not None}
    assert fenced == pytest.approx(expected)
    grid = collect(sr.hourly_grid(hourly, size=size), first)["a"]
    assert [grid[i] for i in range(len(values))] == values
    filled = collect(sr.interpolate(hourly, size=size), first)["a"]
    assert sorted(filled) == list(range(len(values)))
    assert all(filled[i] == v for i, v in enumerate(values) if v is not None)


def test_spike_in_constant_series_is_fenced(spark, hours):
    values = [10.0] * 100
    values[50] = 1000.0
    fenced = collect(sr.prepare_series(hours({"a": values}), "seq"), start_hour(spark))["a"]
    assert all(v == pytest.approx(10.0, abs=1e-7) for v in fenced.values()) and len(fenced) == 100


def test_sustained_plateau_is_removed(spark, hours, catalogue):
    df = hours({"NRMMDL": [90.0] * 168 + [703.0] * 96})
    out = collect(sr.prepare_series(df, "seq", sr.station_bands(catalogue)), start_hour(spark))["NRMMDL"]
    assert len(out) == 167 and out == pytest.approx(dict.fromkeys(out, 218.6))


def test_band_clips_short_series_without_mask(spark, hours, catalogue):
    df = hours({"CAVMSI": [999.0] * 50})
    out = collect(sr.prepare_series(df, "seq", sr.station_bands(catalogue)), start_hour(spark))["CAVMSI"]
    assert len(out) == 50 and out == pytest.approx(dict.fromkeys(out, 137.88))


def test_unknown_station_is_empty(spark, hours):
    assert sr.prepare_series(hours({"CAVMSI": [1.0]}), "seq").filter("station_code = 'NOPE'").isEmpty()


def test_last_reading_of_a_timestamp_wins(spark, hours):
    df = hours({"a": [1.0, 2.0]}).union(
        hours({"a": [5.0]}).withColumn("seq", F.lit(99).cast("bigint"))
    ).union(hours({"a": [None]}).withColumn("seq", F.lit(100).cast("bigint")))
    rows = {r["timestamp"].hour: r["water_level"] for r in sr.dedup_timestamps(df, "seq").collect()}
    assert rows == {0: 5.0, 1: 2.0}


def test_one_hot_station_does_not_change_the_others(spark, hours):
    """A station holding most of the rows is cut into many blocks like any other."""
    hot, small = noisy(6, 3000, gaps=0.2), noisy(7, 150)
    got = collect(sr.prepare_series(hours({"hot": hot, "small": small}), "seq", size=64), start_hour(spark))
    assert got["hot"] == pytest.approx(brute.clean(hot, None))
    assert got["small"] == pytest.approx(brute.clean(small, None))


def test_a_gap_of_two_centuries(spark):
    rows = [("A", 0, 1.0), ("A", 1_750_000, 2.0)]
    filled = sr.interpolate(spark.createDataFrame(rows, "station_code string, hour bigint, level double"))
    got = filled.agg(F.count("*"), F.min("hour"), F.max("hour"), F.sum("level")).first()
    assert (got[0], got[1], got[2]) == (1_750_001, 0, 1_750_000) and got[3] == pytest.approx(1.5 * 1_750_001)
