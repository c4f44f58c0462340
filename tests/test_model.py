"""Training, recursion and risk snapshot on a small seasonal data set."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import features as fx
from gaugeworks.operators import risk as rk
from gaugeworks.plans import forecast as fc

FIRST = 490_900


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = []
    for code, base, n in (("CAVMSI", 81.7, 420), ("YMNCKT", 136.6, 420), ("GDBDCL", 40.0, 150)):
        for i in range(n):
            level = base + 0.3 * math.sin(2 * math.pi * i / 24) + rng.gauss(0, 0.02)
            rows.append((code, FIRST + i, level, 0.0, 1000.0))
    schema = "station_code string, hour bigint, level double, band_low double, band_high double"
    return spark.createDataFrame(rows, schema).persist()


@pytest.fixture(scope="module")
def trained(spark, series, catalogue, tmp_path_factory):
    frame = fx.training_frame(series, catalogue).persist()
    out = str(tmp_path_factory.mktemp("model"))
    done = fc.run_training(spark, frame, out, patience=4, maxIter=12, maxDepth=3)
    return done.model, fc.predicted(done.model, frame).persist(), done.bands


def test_stop_waits_for_its_patience():
    falling = [1 / (i + 1) for i in range(80)]
    assert fc.best_round(falling, 50) == (80, False)
    late = [5.0, *[6.0] * 48, 4.0, *[6.0] * 49]
    assert fc.best_round(late, 50) == (50, False)
    assert fc.best_round([*late, 6.0, 1.0], 50) == (50, True)
    assert fc.best_round([5.0, *[6.0] * 50], 50) == (1, True)


def test_more_than_one_tree_survives(trained):
    assert 1 < trained[0].getNumTrees <= 12


def test_saved_artefacts_hold_the_report(spark, trained):
    bands = {r["station_code"] for r in trained[2].collect()}
    assert bands == {"CAVMSI", "YMNCKT"}


def test_report(trained):
    _, rows, bands = trained
    report = fc.training_report(rows, bands).first()
    assert report["rows"] == 2 * (420 - 169) and report["val_mae_m"] < 0.5
    assert [b["station_code"] for b in report["band_offsets"]] == ["CAVMSI", "YMNCKT"]


def test_recursive_forecast_equals_one_step_at_a_time(spark, series, catalogue, trained):
    model, _, bands = trained
    states = fc.forecast_states(series, catalogue, bands)
    assert {r[0] for r in states.select("station_code").collect()} == {"CAVMSI", "YMNCKT"}
    fan = {(r["station_code"], r["step"]): r for r in fc.recursive_forecast(model, states, 4).collect()}
    assert len(fan) == 8
    grown = series.select("station_code", "hour", "level").filter("station_code = 'CAVMSI'")
    for step in range(1, 5):
        features = fx.series_features(fx.numbered(grown))
        last = features.filter(F.col("position") == F.col("series_rows") - 1)
        mean = fc.predicted(model, fx.encode_stations(last, catalogue)).first()["prediction"]
        assert fan["CAVMSI", step]["mean"] == pytest.approx(mean)
        row = [("CAVMSI", FIRST + 420 + step - 1, mean)]
        grown = grown.union(spark.createDataFrame(row, "station_code string, hour bigint, level double"))


def test_fan_and_risk_invariants(series, catalogue, trained):
    model, _, bands = trained
    fan = fc.recursive_forecast(model, fc.forecast_states(series, catalogue, bands), 24).persist()
    assert fan.filter("NOT (low <= mean AND mean <= high)").isEmpty() and fan.count() == 48
    assert fan.filter(F.abs(F.col("mean") - F.col("last_level")) > 5).isEmpty()
    risks = fc.risk_snapshot(fan, catalogue).collect()
    assert len(risks) == 2 and all(0 <= r["risk_score"] <= 100 for r in risks)


# against plain Python


def stumps(x, y, rounds, step, least):
    """Boosted depth-1 trees on squared loss: predictions of every prefix of the rounds, as functions."""
    import numpy as np

    trees, fitted = [], np.zeros(len(y))
    for turn in range(rounds):
        target = y if turn == 0 else 2 * (y - fitted)
        best = (-1.0,)
        for f in range(x.shape[1]):
            order = np.argsort(x[:, f], kind="stable")
            sums, total = np.cumsum(target[order]), target.sum()
            for k in range(least, len(y) - least + 1):
                if x[order[k - 1], f] == x[order[k], f]:
                    continue
                gain = sums[k - 1] ** 2 / k + (total - sums[k - 1]) ** 2 / (len(y) - k)
                if gain > best[0]:
                    edge = (x[order[k - 1], f] + x[order[k], f]) / 2
                    best = (gain, f, edge, sums[k - 1] / k, (total - sums[k - 1]) / (len(y) - k))
        _, f, edge, low, high = best
        weight = 1.0 if turn == 0 else step
        trees.append((f, edge, weight * low, weight * high))
        fitted = fitted + np.where(x[:, f] <= edge, weight * low, weight * high)
    return lambda rows, n: sum(np.where(rows[:, f] <= e, a, b) for f, e, a, b in trees[:n])


def test_training_equals_plain_boosting(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    names = fx.model_inputs()
    x = rng.normal(size=(300, len(names)))
    y = 2 * x[:, 3] + np.sin(2 * x[:, 7]) + 0.1 * rng.normal(size=300)
    holdout = np.arange(300) >= 240
    rows = [(*map(float, r), float(t), bool(h)) for r, t, h in zip(x, y, holdout)]
    frame = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names) + ", target double, is_holdout boolean")
    settings = dict(maxDepth=1, subsamplingRate=1.0, featureSubsetStrategy="all", maxBins=512, stepSize=0.3, minInstancesPerNode=4)
    model = fc.train(frame, patience=3, maxIter=9, **settings)
    plain = stumps(x[~holdout], y[~holdout], 9, 0.3, 4)
    errors = [float(np.mean((plain(x[holdout], n) - y[holdout]) ** 2)) for n in range(1, 10)]
    assert model.getNumTrees == fc.best_round(errors, 3)[0]
    got = np.array([r["prediction"] for r in fc.predicted(model, frame.coalesce(1)).collect()])
    order = np.array([r["target"] for r in fc.predicted(model, frame.coalesce(1)).collect()])
    assert np.allclose(order, y) and np.allclose(got, plain(x, model.getNumTrees), atol=1e-9)


def test_bands_are_the_quantiles_of_the_residuals(trained):
    import numpy as np

    _, rows, bands = trained
    found = {}
    for r in rows.collect():
        found.setdefault(r["station_code"], []).append(r["target"] - r["prediction"])
    for r in bands.collect():
        low, high = np.quantile(found[r["station_code"]], [0.1, 0.9])
        assert (r["low_offset"], r["high_offset"]) == (pytest.approx(low, abs=6e-5), pytest.approx(high, abs=6e-5))


def test_risk_equals_plain_python(series, catalogue, trained):
    model, _, bands = trained
    fan = fc.recursive_forecast(model, fc.forecast_states(series, catalogue, bands), 24).collect()
    danger = {r["station_code"]: r["danger_level"] for r in catalogue.collect()}
    got = {r["station_code"]: r for r in fc.risk_snapshot(series.sparkSession.createDataFrame(fan), catalogue).collect()}
    for code, r in got.items():
        path = [f["mean"] for f in sorted((f for f in fan if f["station_code"] == code), key=lambda f: f["step"])]
        last = next(f["last_level"] for f in fan if f["station_code"] == code)
        span = max(0.5, 0.4 * abs(danger[code] - last))
        distance = danger[code] - max(last, *path)
        steps = [b - a for a, b in zip(path, path[1:])]
        late = path[-1] - path[-1 - rk.SURGE_STEPS] if len(path) > rk.SURGE_STEPS else rk.SHORT_SURGE_FACTOR * max(0, *steps)
        first = next((i + 1 for i, v in enumerate(path) if v >= danger[code]), None)
        urgency = 1.0 if first is None else min(1.0, max(0.0, 1 - first / rk.URGENCY_HOURS))
        score = min(rk.PROXIMITY_POINTS, max(0.0, rk.PROXIMITY_POINTS * (1 - distance / span)))
        score += rk.CROSSING_POINTS * (0.5 + 0.5 * urgency) if distance <= 0 else 0.0
        score += rk.SURGE_POINTS * min(1.0, max(0.0, late / span))
        assert r["risk_score"] == pytest.approx(min(100.0, score))


def test_quantiles_of_a_hot_station_and_of_odd_values(spark):
    import numpy as np

    from gaugeworks.operators.quantiles import exact_quantiles_by

    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.integers(0, 500, 4500)] + [(None, 1.0), (None, 3.0), ("one", 2.0)]
    rows += [(f"s{k % 9}", float(rng.normal())) for k in range(400)] + [("s1", None), ("s2", math.nan), ("none", None), ("s3", math.inf)]
    frame = spark.createDataFrame(rows, "station_code string, v double").repartition(5)
    got = {r["station_code"]: r for r in exact_quantiles_by(frame, "station_code", "v", [0.0, 0.1, 0.5, 0.9, 1.0]).collect()}
    values = {}
    for code, v in rows:
        if v is not None and math.isfinite(v):
            values.setdefault(code, []).append(v)
    assert got.keys() == values.keys()
    for code, held in values.items():
        assert got[code]["rows"] == len(held)
        assert got[code]["quantiles"] == pytest.approx(np.quantile(held, [0.0, 0.1, 0.5, 0.9, 1.0]).tolist())
    assert exact_quantiles_by(frame.limit(0), "station_code", "v", [0.5]).isEmpty()
