"""Training, saved artefacts, recursive forecast and risk snapshot of all stations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.functions.seasonal import seasonal_encodings
from gaugeworks.operators.blocks import KEY, hour_timestamp
from gaugeworks.operators.features import CATEGORIES, DIFFS, LAGS, ROLLS, category_codes, model_inputs
from gaugeworks.operators.latest import last_n
from gaugeworks.operators.quantiles import exact_quantiles_by
from gaugeworks.operators.risk import MAX_HORIZON, bounded_horizon, residual_fan, risk_scores
from gaugeworks.session import cut_lineage
from gaugeworks.sources.publish import write_json, write_parquet

# --- Fixed values: model settings ------------------------------------------
MODEL = {
    "maxDepth": 7,
    "stepSize": 0.05,
    "subsamplingRate": 0.85,
    "featureSubsetStrategy": "0.9",
    "minInstancesPerNode": 4,
    "maxIter": 600,
    "seed": 42,
}
PATIENCE = 50
BAND_PROBS = [0.1, 0.9]
BAND_MIN_ROWS = 100
MIN_CLEAN_HOURS = 170
# ---------------------------------------------------------------------------
STEPS_PER_CUT = 6
STATE_HOURS = max(*LAGS, *[n for n, _ in ROLLS], *DIFFS) + 1


def assemble(frame: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=model_inputs(), outputCol="features").transform(frame)


def best_round(errors: list[float], patience: int) -> tuple[int, bool]:
    """Rounds of the best prefix, and whether ``patience`` rounds without gain followed it."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def train(frame: DataFrame, patience: int = PATIENCE, **settings) -> GBTRegressionModel:
    """One boosted-tree model over all stations, stopped early on the hold-out rows.

    The hold-out error of every prefix of the trees is taken; the first best one that
    ``patience`` rounds do not improve on wins. Rounds grow from a little over the
    patience up to ``maxIter``, and the winning number of rounds is fitted with the same seed, which gives
    the same first trees.
    """
    wanted = {**MODEL, **settings}
    rows = cut_lineage(assemble(frame).select("features", "target", "is_holdout"))
    learning, held = rows.filter("NOT is_holdout"), rows.filter("is_holdout")

    def fitted(rounds: int) -> GBTRegressionModel:
        return GBTRegressor(labelCol="target", featuresCol="features", **{**wanted, "maxIter": rounds}).fit(learning)

    rounds, empty = min(patience + 10, wanted["maxIter"]), held.isEmpty()
    while True:
        model = fitted(rounds)
        if empty:
            return model
        best, stopped = best_round(model.evaluateEachIteration(held, "squared"), patience)
        if stopped or rounds == wanted["maxIter"]:
            return model if best == rounds else fitted(best)
        rounds = min(2 * rounds, wanted["maxIter"])


def predicted(model: GBTRegressionModel, frame: DataFrame) -> DataFrame:
    return model.transform(assemble(frame)).drop("features")


def mean_absolute_error(rows: DataFrame) -> DataFrame:
    """Mean absolute error over rows with ``prediction`` and ``target``."""
    return rows.agg(F.avg(F.abs(F.col("prediction") - F.col("target"))).alias("mae"), F.count("*").alias("rows"))


def residual_bands(rows: DataFrame, min_rows: int = BAND_MIN_ROWS) -> DataFrame:
    """10 % and 90 % residual quantiles per station with enough rows (A20), no station in one task."""
    found = exact_quantiles_by(rows.withColumn("residual", F.col("target") - F.col("prediction")), KEY, "residual", BAND_PROBS)
    counted = rows.groupBy(KEY).agg(F.count("*").alias("held")).filter(F.col("held") >= min_rows)
    return found.join(counted, KEY, "left_semi").select(
        KEY,
        F.round(F.get("quantiles", F.lit(0)), 4).alias("low_offset"),
        F.round(F.get("quantiles", F.lit(1)), 4).alias("high_offset"),
    )


def training_report(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """Row count, hold-out error and bands as one document."""
    held = mean_absolute_error(rows.filter("is_holdout"))
    band_list = bands.agg(F.array_sort(F.collect_list(F.struct(KEY, "low_offset", "high_offset"))))
    return rows.agg(F.count("*").alias("rows")).select(
        "rows", F.round(held.select("mae").scalar(), 4).alias("val_mae_m"), band_list.scalar().alias("band_offsets")
    )


@dataclass(frozen=True)
class Trained:
    """What a training job leaves: the model, residual bands and the report document."""

    model: GBTRegressionModel
    bands: DataFrame
    report: DataFrame


def run_training(spark: SparkSession, frame: DataFrame, out: str, **settings) -> Trained:
    """Train, measure and write model, bands and report under ``out``."""
    frame = cut_lineage(frame)
    model = train(frame, **settings)
    rows = cut_lineage(predicted(model, frame))
    bands = residual_bands(rows)
    model.write().overwrite().save(f"{out}/model")
    write_parquet(bands, f"{out}/bands")
    write_parquet(rows.select(KEY, "hour", "is_holdout", "target", "prediction"), f"{out}/fitted")
    write_parquet(training_report(rows, spark.read.parquet(f"{out}/bands")), f"{out}/report")
    write_json(spark.read.parquet(f"{out}/report"), f"{out}/report-json")
    return load_training(spark, out)


def load_training(spark: SparkSession, out: str) -> Trained:
    """The artefacts of :func:`run_training`."""
    return Trained(
        GBTRegressionModel.load(f"{out}/model"), spark.read.parquet(f"{out}/bands"), spark.read.parquet(f"{out}/report")
    )


def state_features(levels: Column, hour: Column) -> dict[str, Column]:
    """The model inputs of a series' newest row from its last levels, oldest first.

    The same lags, windows and differences as in training, on one array per station.
    """

    def roll(n: int, stat: str) -> Column:
        part = F.slice(levels, -n, n)
        mean = F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / n
        if stat == "mean":
            return mean
        squares = F.aggregate(F.transform(part, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x)
        return F.sqrt(squares / (n - 1))

    return {
        **seasonal_encodings(hour_timestamp(hour)),
        **{f"lag_{k}": F.element_at(levels, -1 - k) for k in LAGS},
        **{f"roll{n}_{stat}": roll(n, stat) for n, stat in ROLLS},
        **{f"diff_{k}": F.element_at(levels, -1) - F.element_at(levels, -1 - k) for k in DIFFS},
    }


def forecast_states(series: DataFrame, catalogue: DataFrame, bands: DataFrame) -> DataFrame:
    """One row per trained station with enough history: its last levels, oldest first.

    The series is written once; its count and its last rows read that.
    """
    known = series.join(bands.select(KEY), KEY, "left_semi").select(KEY, "hour", "level")
    held = cut_lineage(known)
    newest = last_n(held, STATE_HOURS, time="hour", cut=False)
    counted = held.groupBy(KEY).agg(F.count("*").alias("clean_hours"))
    path = F.array_sort(F.collect_list(F.struct("hour", "level")))
    return (
        newest.groupBy(KEY)
        .agg(F.max("hour").alias("last_hour"), path.alias("path"))
        .join(counted.filter(F.col("clean_hours") >= MIN_CLEAN_HOURS), KEY)
        .join(bands, KEY)
        .join(category_codes(catalogue), KEY)
        .select(
            KEY,
            "last_hour",
            F.transform("path", lambda e: e["level"]).alias("levels"),
            "low_offset",
            "high_offset",
            *[f"{c}_id" for c in CATEGORIES],
        )
    )


def recursive_forecast(
    model: GBTRegressionModel, states: DataFrame, horizon: int, max_horizon: int = MAX_HORIZON
) -> DataFrame:
    """Hour-by-hour forecast of all stations, each step fed back as a level.

    The state of a station is one row with its last 169 levels; a step is the model's own
    transform over all stations. Lineage is cut every few steps, so plans stay short.
    """
    steps = bounded_horizon(horizon, max_horizon)
    codes = [f"{c}_id" for c in CATEGORIES]
    keep = [KEY, "last_hour", "low_offset", "high_offset", *codes]
    none = F.array().cast("array<double>")
    now = states.withColumns({"last_level": F.element_at("levels", -1), "means": none})
    for step in range(steps):
        inputs = now.withColumns(state_features(F.col("levels"), F.col("last_hour") + step))
        mean = F.array("prediction")
        now = predicted(model, inputs).select(
            *keep,
            "last_level",
            F.concat(F.slice("levels", 2, STATE_HOURS - 1), mean).alias("levels"),
            F.concat("means", mean).alias("means"),
        )
        if (step + 1) % STEPS_PER_CUT == 0 or step + 1 == steps:
            now = cut_lineage(now)
    low, high = residual_fan(F.col("mean"), F.col("low_offset"), F.col("high_offset"))
    return now.select("*", F.posexplode("means").alias("index", "mean")).select(
        KEY,
        (F.col("index") + 1).alias("step"),
        hour_timestamp(F.col("last_hour") + F.col("index") + 1).alias("forecast_ts"),
        "mean",
        low.alias("low"),
        high.alias("high"),
        "last_level",
    )


def risk_snapshot(forecast: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Risk of every forecast station in one plan."""
    danger = catalogue.select(KEY, "danger_level")
    return risk_scores(forecast.join(danger, KEY, "left"))
