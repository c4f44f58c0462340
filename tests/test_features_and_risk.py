"""Feature frame and forecast post-processing."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import features as fx
from gaugeworks.operators import risk as rk


def series_of(spark, data: dict[str, list[tuple[int, float]]]):
    rows = [(c, h, v, 0.0, 1000.0) for c, points in data.items() for h, v in points]
    return spark.createDataFrame(
        rows, "station_code string, hour bigint, level double, band_low double, band_high double"
    )


def holey(seed, n):
    rng = random.Random(seed)
    hour, out = 490_000, []
    for _ in range(n):
        hour += 1 if rng.random() > 0.02 else rng.randint(2, 90)
        out.append((hour, round(rng.uniform(0, 100), 3)))
    return out


@pytest.mark.parametrize("size", [64, 2048])
def test_features_count_rows_not_hours(spark, size):
    data = {"a": holey(1, 400), "b": holey(2, 30), "c": [(490_000, 1.0)]}
    placed = fx.numbered(series_of(spark, data), size=size)
    rows = {(r["station_code"], r["position"]): r for r in fx.series_features(placed, size).collect()}
    assert len(rows) == 431
    for code, points in data.items():
        level = [v for _, v in points]
        for i, (hour, _) in enumerate(points):
            r = rows[code, i]
            assert r["hour"] == hour and r["series_rows"] == len(points)
            for k in fx.LAGS:
                assert r[f"lag_{k}"] == (level[i - k] if i >= k else None)
            for n, stat in fx.ROLLS:
                part = level[i - n + 1 : i + 1] if i >= n - 1 else None
                want = None if part is None else statistics.fmean(part) if stat == "mean" else statistics.stdev(part)
                assert r[f"roll{n}_{stat}"] == (None if want is None else pytest.approx(want))
            for k in fx.DIFFS:
                assert r[f"diff_{k}"] == (pytest.approx(level[i] - level[i - k]) if i >= k else None)
            assert r["target"] == (level[i + 1] if i + 1 < len(level) else None)


def test_feature_list_has_21_columns_and_no_target():
    names = fx.feature_columns()
    assert len(names) == 21 == len(set(names))
    assert not {"target", "y", "hour", "dayofyear"} & set(names)


def test_training_frame_selects_stations(spark, catalogue):
    ok, short, junk = holey(3, 400), holey(4, 200), [(h, 900.0) for h, _ in holey(5, 400)]
    df = series_of(spark, {"CAVMSI": ok, "GDBDCL": short, "NRMMDL": junk, "OTHER": ok})
    frame = fx.training_frame(df, catalogue, size=256)
    by_station = {r[0]: (r[1], r[2]) for r in frame.groupBy("station_code").agg(F.count("*"), F.count_if("is_holdout")).collect()}
    # 168 rows lack the longest lag, the last one lacks the target
    assert by_station == {"CAVMSI": (400 - 168 - 1, 400 - 360 - 1)}
    assert frame.select(*fx.model_inputs()).dropna().count() == 231


def forecast(spark, mean, last, danger):
    rows = [("S", i + 1, float(m), last, danger) for i, m in enumerate(mean)]
    return spark.createDataFrame(
        rows, "station_code string, step int, mean double, last_level double, danger_level double"
    )


def score(last, mean, danger):
    """The risk formula, stated plainly."""
    band = max(0.5, 0.4 * abs(danger - last))
    gap = danger - max(last, max(mean))
    near = min(max(70 * (1 - gap / band), 0), 70)
    first = next((i + 1 for i, m in enumerate(mean) if m >= danger), None)
    urgency = 1.0 if first is None else min(max(1 - first / 336, 0), 1)
    cross = 30 * (0.5 + 0.5 * urgency) if gap <= 0 else 0.0
    if len(mean) > 24:
        rise = (mean[-1] - mean[-25]) / band
    else:
        rise = max([0.0] + [b - a for a, b in zip(mean, mean[1:])]) * 12 / band
    return min(max(near + cross + 15 * min(max(rise, 0), 1), 0), 100)


def test_hours_to_threshold(spark):
    df = forecast(spark, [10, 11, 12, 13], 10.0, 11.5).withColumn("far", F.lit(99.0)).withColumn("none", F.lit(None).cast("double"))
    assert rk.hours_to_threshold(df, "danger_level").first()[1] == 3
    assert rk.hours_to_threshold(df, "far").first()[1] is None
    assert rk.hours_to_threshold(df, "none").first()[1] is None


def test_risk_of_a_rising_forecast(spark):
    r = rk.risk_scores(forecast(spark, [11, 12, 13, 14], 10.0, 12.5)).first()
    assert r["proximity"] == 70.0
    assert r["crossing"] == pytest.approx(30 * (0.5 + 0.5 * (1 - 3 / 336)))
    assert (r["surge"], r["risk_score"], r["hours_to_danger"]) == (15.0, 100.0, 3)


@pytest.mark.parametrize("last, danger", [(None, 12.5), (10.0, None)])
def test_risk_needs_last_and_danger(spark, last, danger):
    r = rk.risk_scores(forecast(spark, [11, 12], last, danger)).first()
    assert (r["risk_score"], r["proximity"], r["crossing"], r["surge"]) == (None, None, 0.0, 0.0)


def test_risk_matches_the_formula(spark):
    rng = random.Random(11)
    cases = []
    for n in (1, 2, 24, 25, 26, 72, 256):
        for _ in range(6):
            last, danger = rng.uniform(0, 20), rng.uniform(0, 20)
            cases.append((last, danger, [rng.uniform(0, 20) for _ in range(n)]))
    rows = [
        (str(i), s + 1, m, last, danger) for i, (last, danger, mean) in enumerate(cases) for s, m in enumerate(mean)
    ]
    df = spark.createDataFrame(rows, "station_code string, step int, mean double, last_level double, danger_level double")
    got = {r["station_code"]: r["risk_score"] for r in rk.risk_scores(df.repartition(8)).collect()}
    for i, (last, danger, mean) in enumerate(cases):
        assert got[str(i)] == pytest.approx(score(last, mean, danger)), i
        assert 0 <= got[str(i)] <= 100


def test_horizon_is_clamped(spark):
    last = spark.sql("SELECT 'S' AS station_code, timestamp'2026-01-03 00:00:00' AS timestamp")
    assert rk.forecast_axis(last, 1000).count() == 256
    assert rk.forecast_axis(last, 0).count() == 1
    assert str(rk.forecast_axis(last, 2).agg(F.max("forecast_ts")).first()[0]) == "2026-01-03 02:00:00"


def test_fan_is_ordered_and_anchored(spark):
    rows = [("S", 1, 5.0, 5.0, 6.0, 4.0, 7.0), ("S", 2, 6.0, 6.0, 5.0, 8.0, 7.0)]
    df = spark.createDataFrame(rows, "station_code string, step int, mean double, median double, low double, high double, last_level double")
    fan = [tuple(r)[2:5] for r in rk.repair_fan(df).orderBy("step").collect()]
    assert fan == [(7.0, 7.0, 7.0), (8.0, 7.0, 10.0)]
    unanchored = rk.repair_fan(df.withColumn("last_level", F.lit(None).cast("double"))).orderBy("step").first()
    assert unanchored["mean"] == 5.0


def test_ranking_card_and_fan_table(spark, catalogue):
    risks = rk.risk_scores(forecast(spark, [11, 12, 13, 14], 10.0, 12.5)).withColumn("station_code", F.lit("CAVMSI"))
    low = risks.withColumns({"station_code": F.lit("X"), "risk_score": F.lit(12.9), "hours_to_danger": F.lit(None).cast("bigint")})
    both = risks.unionByName(low)
    assert [tuple(r) for r in rk.risk_ranking(both, catalogue).collect()] == [
        ("Cauvery at Musiri (CAVMSI)", 100, "3"),
        ("X", 12, "∞"),
    ]
    assert rk.highest_risk(both).first()[0] == 100
    assert rk.forecast_card(risks).first()["forecast_peak"] == 14.0
    history = spark.range(48).select(
        F.lit("CAVMSI").alias("station_code"),
        (F.timestamp_seconds(1767225600 + F.col("id") * 3600)).alias("timestamp"),
        (80 + F.col("id") / 48).alias("level"),
    )
    last = history.agg(F.max("timestamp").alias("timestamp")).withColumn("station_code", F.lit("CAVMSI"))
    ahead = rk.forecast_axis(last, 24).withColumns({"mean": F.lit(81.0), "low": F.lit(80.5), "high": F.lit(81.5)})
    table = rk.fan_table(history, ahead, catalogue, tail_hours=40)
    assert table.count() == 64 and table.filter("observed IS NOT NULL").count() == 40
    assert math.isclose(table.first()["danger_level"], 83.115)
