"""Queries over series cleaning, features, forecast post-processing and models."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W, functions as F

from gaugeworks.bindings import tables as t
from gaugeworks.bindings.registry import query
from gaugeworks.functions.levels import clip_to_band, level_band
from gaugeworks.functions.seasonal import seasonal_encodings
from gaugeworks.operators import features as fx
from gaugeworks.operators import risk as rk
from gaugeworks.operators import series as sr
from gaugeworks.operators.blocks import KEY, hour_timestamp
from gaugeworks.operators.quantiles import exact_quantiles_by
from gaugeworks.plans import forecast as fc
from gaugeworks.session import checkpoint_dir, cut_lineage

# --- SQL of the cleaning steps ----------------------------------------------
LEVEL = t.on_grid("level", "level")
HOURLY_SQL = """dedup AS (
  SELECT station_code, "timestamp", arg_max(water_level, event_id) AS water_level FROM readings
  WHERE water_level IS NOT NULL GROUP BY 1, 2),
hourly AS (
  SELECT station_code, CAST(floor(epoch("timestamp") / 3600) AS BIGINT) AS hour, avg(water_level) AS level
  FROM dedup GROUP BY 1, 2)"""
GRID_SQL = """bounds AS (SELECT station_code, min(hour) AS first_hour, max(hour) AS last_hour FROM hourly GROUP BY 1),
hours AS (SELECT station_code, first_hour, last_hour, unnest(generate_series(first_hour, last_hour)) AS hour FROM bounds),
grid AS (SELECT g.station_code, g.hour, h.level, first_hour, last_hour FROM hours g
  LEFT JOIN hourly h ON h.station_code = g.station_code AND h.hour = g.hour)"""
FENCE_SQL = """med AS (SELECT *, quantile_cont(level, 0.5) OVER (PARTITION BY station_code ORDER BY hour
  ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS median FROM grid),
dev AS (SELECT *, quantile_cont(abs(level - median), 0.5) OVER (PARTITION BY station_code ORDER BY hour
  ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS deviation FROM med),
fence AS (SELECT station_code, hour, first_hour, last_hour, CASE WHEN level IS NOT NULL THEN
  least(greatest(level, median - 8.0 * (1.4826::DOUBLE * deviation + 1e-9)), median + 8.0 * (1.4826::DOUBLE * deviation + 1e-9))
  END AS level FROM dev)"""
BANDS_SQL = """bands AS (SELECT station_code, 0.5 * least(warning_level, danger_level, high_flood_level) AS band_low,
  1.6::DOUBLE * greatest(warning_level, danger_level, high_flood_level) AS band_high FROM catalogue)"""
BANDED_SQL = """banded AS (SELECT f.station_code, hour, first_hour, last_hour, band_low, band_high,
  CASE WHEN level < band_low THEN band_low WHEN level > band_high THEN band_high ELSE level END AS level
  FROM fence f LEFT JOIN bands b ON b.station_code = f.station_code)"""
MASK_SQL = """smooth AS (SELECT *, CASE WHEN count(level) OVER w >= 12 THEN avg(level) OVER w END AS smooth FROM banded
  WINDOW w AS (PARTITION BY station_code ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
cand AS (SELECT *, coalesce(smooth > band_low + 0.5 * (band_high - band_low), false) AS cand FROM smooth),
edge AS (SELECT *, CASE WHEN cand IS DISTINCT FROM lag(cand) OVER (PARTITION BY station_code ORDER BY hour)
  THEN 1 ELSE 0 END AS starts FROM cand),
isle AS (SELECT *, sum(starts) OVER (PARTITION BY station_code ORDER BY hour ROWS UNBOUNDED PRECEDING) AS isle FROM edge),
runs AS (SELECT *, cand AND count(*) OVER (PARTITION BY station_code, isle) >= 48 AS run FROM isle),
masked AS (SELECT station_code, hour, level, band_low, band_high, band_low IS NOT NULL AND last_hour - first_hour + 1 >= 100 AND (
    run OR (lead(hour, 36) OVER (PARTITION BY station_code ORDER BY hour) IS NOT NULL AND
            coalesce(bool_or(run) OVER (PARTITION BY station_code ORDER BY hour ROWS BETWEEN 1 FOLLOWING AND 36 FOLLOWING), false))
    OR coalesce(level >= band_high - 1e-6, false)) AS junk FROM runs)"""


def fill_sql(source: str, result: str, keep: str = "") -> str:
    o = "(PARTITION BY station_code ORDER BY hour ROWS BETWEEN {})"
    back, ahead = o.format("UNBOUNDED PRECEDING AND CURRENT ROW"), o.format("CURRENT ROW AND UNBOUNDED FOLLOWING")
    known = "CASE WHEN level IS NOT NULL THEN hour END"
    return f"""{result}_near AS (SELECT *, last_value(level IGNORE NULLS) OVER {back} AS v0,
  last_value({known} IGNORE NULLS) OVER {back} AS h0, first_value(level IGNORE NULLS) OVER {ahead} AS v1,
  first_value({known} IGNORE NULLS) OVER {ahead} AS h1 FROM {source}),
{result} AS (SELECT station_code, hour, level IS NULL AS filled{keep},
  CASE WHEN level IS NOT NULL THEN level ELSE v0 + (v1 - v0) / (h1 - h0) * (hour - h0) END AS level FROM {result}_near)"""


SERIES_PARTS = [
    t.READINGS_SQL,
    t.CATALOGUE_SQL,
    HOURLY_SQL,
    GRID_SQL,
    FENCE_SQL,
    BANDS_SQL,
    BANDED_SQL,
    MASK_SQL,
    fill_sql("masked", "full_series", ", junk, band_low, band_high"),
    "series AS (SELECT station_code, hour, level, band_low, band_high FROM full_series WHERE NOT junk)",
]
# levels in steps of 1/1024: sums are exact, so both engines form equal means
STEPPED_PARTS = [
    *SERIES_PARTS[:-1],
    """series AS (SELECT station_code, hour, round(level * 1024) / 1024 AS level, band_low, band_high
  FROM full_series WHERE NOT junk)""",
]


def _hourly(spark, sf_dir):
    return sr.hourly_mean(sr.dedup_timestamps(t.readings(spark, sf_dir), "event_id"))


def _bands(spark):
    return sr.station_bands(t.catalogue(spark))


def _series(spark, sf_dir):
    return sr.prepare_series(t.readings(spark, sf_dir), "event_id", _bands(spark))


@query(
    "dedup_ts",
    t.with_ctes(
        t.USER_READINGS_SQL,
        select="""SELECT station_code, "timestamp", arg_max(water_level, event_id) AS water_level FROM user_readings
                  WHERE water_level IS NOT NULL GROUP BY 1, 2""",
    ),
)
def dedup_ts(spark, sf_dir):
    return sr.dedup_timestamps(t.user_readings(spark, sf_dir), "event_id")


@query(
    "hourly_mean",
    t.with_ctes(t.READINGS_SQL, HOURLY_SQL, select="SELECT station_code, hour, " + LEVEL + " FROM hourly"),
    binary=True,
)
def hourly_mean(spark, sf_dir):
    return _hourly(spark, sf_dir)


@query(
    "hourly_grid",
    t.with_ctes(
        t.READINGS_SQL, HOURLY_SQL, GRID_SQL, select="SELECT station_code, hour, " + LEVEL + " FROM grid"
    ),
    binary=True,
)
def hourly_grid(spark, sf_dir):
    return sr.hourly_grid(_hourly(spark, sf_dir)).select(KEY, "hour", "level")


@query(
    "mad_fence",
    t.with_ctes(
        t.READINGS_SQL,
        HOURLY_SQL,
        GRID_SQL,
        FENCE_SQL,
        select="SELECT station_code, hour, " + LEVEL + " FROM fence WHERE level IS NOT NULL",
    ),
    binary=True,
)
def mad_fence(spark, sf_dir):
    return sr.mad_fence(_hourly(spark, sf_dir))


@query(
    "level_band",
    """SELECT c_custkey, round(0.5 * list_min(v), 6) AS band_low, round(1.6::DOUBLE * list_max(v), 6) AS band_high FROM (
         SELECT c_custkey, list_filter([CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END, c_acctbal + 100,
                                        CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 200 END], lambda x: x > 0) AS v
         FROM customer)""",
)
def level_bands(spark, sf_dir):
    key, base = F.col("c_custkey"), F.col("c_acctbal")
    low, high = level_band(F.when(key % 3 != 0, base), base + 100, F.when(key % 5 != 0, base + 200))
    return t.table(spark, sf_dir, "customer").select("c_custkey", low.alias("band_low"), high.alias("band_high"))


@query(
    "band_clip",
    t.with_ctes(
        t.READINGS_SQL,
        t.CATALOGUE_SQL,
        BANDS_SQL,
        select="""SELECT event_id, CASE WHEN water_level < band_low THEN band_low WHEN water_level > band_high THEN band_high
          ELSE water_level END AS water_level FROM readings r LEFT JOIN bands b ON b.station_code = r.station_code""",
    ),
)
def band_clip(spark, sf_dir):
    joined = t.readings(spark, sf_dir).join(_bands(spark), KEY, "left")
    clipped = clip_to_band(F.col("water_level"), F.col("band_low"), F.col("band_high"))
    return joined.select("event_id", clipped.alias("water_level"))


@query(
    "junk_mask",
    t.with_ctes(
        t.READINGS_SQL,
        t.CATALOGUE_SQL,
        HOURLY_SQL,
        GRID_SQL,
        "fence AS (SELECT * FROM grid)",
        BANDS_SQL,
        BANDED_SQL,
        MASK_SQL,
        select="SELECT station_code, hour, " + LEVEL + ", junk FROM masked",
    ),
    binary=True,
)
def junk_mask(spark, sf_dir):
    grid = sr.hourly_grid(_hourly(spark, sf_dir)).join(_bands(spark), KEY, "left")
    banded = grid.withColumn("level", clip_to_band(F.col("level"), F.col("band_low"), F.col("band_high")))
    return sr.junk_mask(banded).select(KEY, "hour", "level", "junk")


@query(
    "interpolate",
    t.with_ctes(
        t.READINGS_SQL,
        HOURLY_SQL,
        GRID_SQL,
        fill_sql("grid", "filled"),
        select="SELECT station_code, hour, filled, " + LEVEL + " FROM filled",
    ),
    binary=True,
)
def interpolate(spark, sf_dir):
    return sr.interpolate(_hourly(spark, sf_dir))


@query(
    "prepare_series",
    t.with_ctes(*SERIES_PARTS, select="SELECT station_code, hour, " + LEVEL + " FROM series"),
    binary=True,
)
def prepare_series(spark, sf_dir):
    return _series(spark, sf_dir).select(KEY, "hour", "level")


@query(
    "prepare_series_unbanded",
    t.with_ctes(
        t.READINGS_SQL,
        HOURLY_SQL,
        GRID_SQL,
        FENCE_SQL,
        fill_sql("fence", "filled"),
        select="SELECT station_code, hour, " + LEVEL + " FROM filled",
    ),
    binary=True,
)
def prepare_series_unbanded(spark, sf_dir):
    return sr.prepare_series(t.readings(spark, sf_dir), "event_id")


SUPPLIER_READINGS_SQL = """readings AS (
  SELECT l_orderkey * 10 + l_linenumber AS event_id, CAST(l_suppkey AS VARCHAR) AS station_code,
         l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS "timestamp", avg(l_quantity) AS water_level
  FROM lineitem GROUP BY 1, 2, 3)"""


def supplier_readings(spark, sf_dir):
    """A station per supplier: quantities shipped, spread over the hours of the day."""
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return (
        t.table(spark, sf_dir, "lineitem")
        .groupBy(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("event_id"),
            F.col("l_suppkey").cast("string").alias(KEY),
            (F.col("l_shipdate").cast("timestamp") + hours).alias("timestamp"),
        )
        .agg(F.avg("l_quantity").alias("water_level"))
    )


@query(
    "supplier_hours",
    t.with_ctes(
        SUPPLIER_READINGS_SQL,
        "dedup AS (SELECT station_code, \"timestamp\", arg_max(water_level, event_id) AS water_level FROM readings GROUP BY 1, 2)",
        """hourly AS (SELECT station_code, CAST(floor(epoch("timestamp") / 3600) AS BIGINT) AS hour, avg(water_level) AS level
           FROM dedup GROUP BY 1, 2)""",
        GRID_SQL,
        FENCE_SQL,
        select="SELECT station_code, hour, " + LEVEL + " FROM fence WHERE level IS NOT NULL",
    ),
    binary=True,
)
def supplier_hours(spark, sf_dir):
    """Sparse many-year series: trailing windows that hold few readings."""
    return sr.mad_fence(sr.hourly_mean(sr.dedup_timestamps(supplier_readings(spark, sf_dir), "event_id")))


@query(
    "supplier_series",
    t.with_ctes(
        SUPPLIER_READINGS_SQL,
        "dedup AS (SELECT station_code, \"timestamp\", arg_max(water_level, event_id) AS water_level FROM readings GROUP BY 1, 2)",
        """hourly AS (SELECT station_code, CAST(floor(epoch("timestamp") / 3600) AS BIGINT) AS hour, avg(water_level) AS level
           FROM dedup GROUP BY 1, 2)""",
        GRID_SQL,
        FENCE_SQL,
        fill_sql("fence", "filled"),
        select="""SELECT station_code, count(*) AS hours, min(hour) AS first_hour, max(hour) AS last_hour,
                  round(avg(level), 4) AS mean_level FROM filled GROUP BY 1""",
    ),
)
def supplier_series(spark, sf_dir):
    """Full cleaned hourly grid of every supplier, folded to its extent and mean."""
    return (
        sr.prepare_series(supplier_readings(spark, sf_dir), "event_id")
        .groupBy(KEY)
        .agg(
            F.count("*").alias("hours"),
            F.min("hour").alias("first_hour"),
            F.max("hour").alias("last_hour"),
            F.round(F.avg("level"), 4).alias("mean_level"),
        )
    )


# --- features ---------------------------------------------------------------
FEATURE_SQL = """numbered AS (SELECT *, row_number() OVER o - 1 AS pos, count(*) OVER (PARTITION BY station_code) AS series_rows,
    avg(CASE WHEN level > band_low + 0.5 * (band_high - band_low) THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY station_code) AS junk_share
  FROM series WINDOW o AS (PARTITION BY station_code ORDER BY hour)),
feat AS (SELECT station_code, hour, pos, series_rows, junk_share, level, """ + ", ".join(
    [f"lag(level, {k}) OVER o AS lag_{k}" for k in fx.LAGS]
    + [
        f"CASE WHEN pos >= {n - 1} THEN {'avg' if stat == 'mean' else 'stddev_samp'}(level) OVER "
        f"(PARTITION BY station_code ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END AS roll{n}_{stat}"
        for n, stat in fx.ROLLS
    ]
    + [f"level - lag(level, {k}) OVER o AS diff_{k}" for k in fx.DIFFS]
) + """, lead(level, 1) OVER o AS target, make_timestamp(hour * 3600000000) AS ts
  FROM numbered WINDOW o AS (PARTITION BY station_code ORDER BY hour)),
seasonal AS (SELECT *, sin(2 * pi() * extract(hour FROM ts) / 24.0) AS sin_hour, cos(2 * pi() * extract(hour FROM ts) / 24.0) AS cos_hour,
  sin(2 * pi() * extract(doy FROM ts) / 365.25) AS sin_doy, cos(2 * pi() * extract(doy FROM ts) / 365.25) AS cos_doy FROM feat)"""
CODES_SQL = """codes AS (SELECT station_code, dense_rank() OVER (ORDER BY station_code) - 1 AS station_code_id,
  dense_rank() OVER (ORDER BY basin_name) - 1 AS basin_name_id,
  CAST(CASE kind WHEN 'manual' THEN 0 WHEN 'telemetry' THEN 1 ELSE -1 END AS BIGINT) AS kind_id FROM catalogue)"""


def rounded(names):
    return ", ".join(t.on_grid(n, n) for n in names)


def _stepped(spark, sf_dir):
    return _series(spark, sf_dir).withColumn("level", F.round(F.col("level") * 1024) / 1024)


def _features(spark, sf_dir):
    return fx.series_features(fx.numbered(_stepped(spark, sf_dir)))


LAG_COLUMNS = [f"lag_{k}" for k in fx.LAGS]
ROLL_COLUMNS = [f"roll{n}_{stat}" for n, stat in fx.ROLLS]
DIFF_COLUMNS = [f"diff_{k}" for k in fx.DIFFS]
SEASONAL_COLUMNS = ["sin_hour", "cos_hour", "sin_doy", "cos_doy"]


def _feature_query(name, names):
    @query(
        name,
        t.with_ctes(*STEPPED_PARTS, FEATURE_SQL, select=f"SELECT station_code, hour, {rounded(names)} FROM seasonal"),
        binary=True,
    )
    def build(spark, sf_dir):
        return _features(spark, sf_dir).select(KEY, "hour", *names)

    return build


lags = _feature_query("lags", LAG_COLUMNS)
rolling_stats = _feature_query("rolling_stats", ROLL_COLUMNS)
diffs = _feature_query("diffs", DIFF_COLUMNS)
target = _feature_query("target", ["level", "target"])


@query(
    "seasonal",
    """SELECT event_id, round(sin(2 * pi() * extract(hour FROM ts) / 24.0), 6) AS sin_hour,
         round(cos(2 * pi() * extract(hour FROM ts) / 24.0), 6) AS cos_hour,
         round(sin(2 * pi() * extract(doy FROM ts) / 365.25), 6) AS sin_doy,
         round(cos(2 * pi() * extract(doy FROM ts) / 365.25), 6) AS cos_doy FROM events""",
)
def seasonal(spark, sf_dir):
    encodings = seasonal_encodings(F.col("timestamp"))
    return t.readings(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in encodings.items()])


@query(
    "category_codes",
    t.with_ctes(
        t.USER_READINGS_SQL,
        t.USER_CATALOGUE_SQL.replace("FROM customer", "FROM (SELECT * FROM customer WHERE c_custkey % 3 <> 0)"),
        CODES_SQL.replace("FROM catalogue", "FROM user_catalogue"),
        select="""SELECT event_id, coalesce(station_code_id, -1) AS station_code_id, coalesce(basin_name_id, -1) AS basin_name_id,
          coalesce(kind_id, -1) AS kind_id FROM user_readings r LEFT JOIN codes c ON c.station_code = r.station_code""",
    ),
)
def category_codes(spark, sf_dir):
    stations = t.user_catalogue(spark, sf_dir).filter("position % 3 <> 0")
    coded = fx.encode_stations(t.user_readings(spark, sf_dir), stations)
    return coded.select("event_id", "station_code_id", "basin_name_id", "kind_id")


@query(
    "junk_share",
    t.with_ctes(
        *SERIES_PARTS,
        select="""SELECT station_code, count(*) AS series_rows, round(avg(CASE WHEN level > band_low + 0.5 * (band_high - band_low)
          THEN 1.0 ELSE 0.0 END), 6) AS junk_share FROM series GROUP BY 1""",
    ),
)
def junk_share(spark, sf_dir):
    return fx.junk_share(_series(spark, sf_dir))


TRAIN_SQL = """train AS (SELECT s.*, c.station_code_id, c.basin_name_id, c.kind_id,
    pos >= floor(0.9::DOUBLE * series_rows) AS is_holdout
  FROM seasonal s JOIN codes c ON c.station_code = s.station_code
  WHERE series_rows >= 216 AND junk_share <= 0.05 AND target IS NOT NULL AND """ + " AND ".join(
    f"{n} IS NOT NULL" for n in LAG_COLUMNS + ROLL_COLUMNS + DIFF_COLUMNS
) + ")"


@query(
    "training_frame",
    t.with_ctes(
        *STEPPED_PARTS,
        FEATURE_SQL,
        CODES_SQL,
        TRAIN_SQL,
        select="SELECT station_code, hour, is_holdout, station_code_id, basin_name_id, kind_id, "
        + rounded(SEASONAL_COLUMNS + LAG_COLUMNS + ROLL_COLUMNS + DIFF_COLUMNS + ["target"])
        + " FROM train",
    ),
    binary=True,
)
def training_frame(spark, sf_dir):
    return _training(spark, sf_dir).select(KEY, "hour", "is_holdout", *fx.model_inputs(), "target")


def _training(spark, sf_dir):
    return fx.training_frame(_stepped(spark, sf_dir), t.catalogue(spark))


# --- forecast post-processing on a stand-in forecast ------------------------
# the last 72 clean hours of a station stand in for its forecast, the row
# before them for its last level
PSEUDO_SQL = """pseudo_rows AS (SELECT station_code, hour, level,
    row_number() OVER (PARTITION BY station_code ORDER BY hour DESC) AS back FROM series),
pseudo AS (SELECT p.station_code, 73 - back AS step, hour, level AS mean, last_level, danger_level
  FROM pseudo_rows p JOIN (SELECT station_code, level AS last_level FROM pseudo_rows WHERE back = 73) l
    ON l.station_code = p.station_code
  LEFT JOIN catalogue c ON c.station_code = p.station_code WHERE back <= 72)"""
RISK_SQL = """folded AS (SELECT station_code, any_value(last_level) AS last_level, any_value(danger_level) AS danger_level,
    max(mean) AS peak, min(CASE WHEN mean >= danger_level THEN step END) AS first_step,
    arg_max(mean, step) - max(CASE WHEN step = 48 THEN mean END) AS late_rise FROM pseudo GROUP BY 1),
ranged AS (SELECT *, greatest(0.5, 0.4::DOUBLE * abs(danger_level - last_level)) AS wb,
    danger_level - greatest(last_level, peak) AS dist FROM folded),
parts AS (SELECT *, danger_level IS NOT NULL AS known,
    greatest(0.0, least(70.0, 70 * (1 - dist / wb))) AS prox,
    CASE WHEN dist <= 0 THEN 30 * (0.5 + 0.5 * coalesce(greatest(0.0, least(1.0, 1 - first_step / 336.0::DOUBLE)), 1.0)) ELSE 0 END AS crossing,
    15 * greatest(0.0, least(1.0, late_rise / wb)) AS surge FROM ranged),
risk AS (SELECT station_code, last_level, peak,
    CASE WHEN known THEN greatest(0.0, least(100.0, prox + crossing + surge)) END AS risk_score,
    CASE WHEN known THEN prox END AS proximity, CASE WHEN known THEN crossing ELSE 0 END AS crossing,
    CASE WHEN known THEN surge ELSE 0 END AS surge, first_step AS hours_to_danger FROM parts)"""
RISK_PARTS = [*SERIES_PARTS, PSEUDO_SQL, RISK_SQL]


def _pseudo(spark, sf_dir):
    series = _series(spark, sf_dir).select(KEY, "hour", "level")
    tail = rk.last_n(series, 73, time="hour")
    back = F.row_number().over(W.partitionBy(KEY).orderBy(F.desc("hour")))
    ranked = tail.withColumn("back", back)
    last = F.max(F.when(F.col("back") == 73, F.col("level"))).over(W.partitionBy(KEY))
    danger = t.catalogue(spark).select(KEY, "danger_level")
    return (
        ranked.withColumn("last_level", last)
        .filter(F.col("last_level").isNotNull() & (F.col("back") <= 72))
        .withColumns({"step": 73 - F.col("back"), "mean": F.col("level")})
        .join(danger, KEY, "left")
        .select(KEY, "step", "hour", "mean", "last_level", "danger_level")
    )


def _risk(spark, sf_dir):
    return rk.risk_scores(_pseudo(spark, sf_dir))


@query(
    "hours_to_threshold",
    t.with_ctes(
        *RISK_PARTS,
        select="""SELECT station_code, min(CASE WHEN mean >= danger_level THEN step END) AS hours_to_threshold
                  FROM pseudo GROUP BY 1""",
    ),
)
def hours_to_threshold(spark, sf_dir):
    return rk.hours_to_threshold(_pseudo(spark, sf_dir), "danger_level")


@query(
    "risk_score",
    t.with_ctes(
        *RISK_PARTS,
        select="SELECT station_code, hours_to_danger, "
        + rounded(["last_level", "peak", "risk_score", "proximity", "crossing", "surge"])
        + " FROM risk",
    ),
    binary=True,
)
def risk_score(spark, sf_dir):
    return _risk(spark, sf_dir)


@query(
    "risk_ranking",
    t.with_ctes(
        *RISK_PARTS,
        select="""SELECT coalesce(station_name || ' (' || r.station_code || ')', r.station_code) AS station,
          CAST(floor(risk_score) AS BIGINT) AS risk, coalesce(CAST(hours_to_danger AS VARCHAR), '∞') AS hours_to_danger
          FROM risk r LEFT JOIN catalogue c ON c.station_code = r.station_code ORDER BY risk_score DESC""",
    ),
)
def risk_ranking(spark, sf_dir):
    return rk.risk_ranking(_risk(spark, sf_dir), t.catalogue(spark))


@query(
    "max_risk",
    t.with_ctes(*RISK_PARTS, select="SELECT CAST(floor(least(max(risk_score), 100)) AS BIGINT) AS max_risk FROM risk"),
)
def max_risk(spark, sf_dir):
    return rk.highest_risk(_risk(spark, sf_dir))


@query(
    "forecast_card",
    t.with_ctes(
        *RISK_PARTS,
        select="""SELECT station_code, round(last_level, 2) AS last_observed, round(peak, 2) AS forecast_peak,
          round(risk_score, 0) AS risk_score, round(proximity, 0) AS proximity, round(crossing, 0) AS crossing,
          round(surge, 0) AS surge, coalesce(CAST(hours_to_danger AS VARCHAR), '∞') AS hours_to_danger FROM risk""",
    ),
)
def forecast_card(spark, sf_dir):
    return rk.forecast_card(_risk(spark, sf_dir))


@query(
    "forecast_axis",
    """SELECT user_id, step, max_ts + to_hours(CAST(step AS INTEGER)) AS forecast_ts FROM (
         SELECT user_id, max(ts) AS max_ts, unnest(generate_series(1, 256)) AS step FROM events GROUP BY 1)""",
)
def forecast_axis(spark, sf_dir):
    last = t.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max(F.col("ts").cast("timestamp")).alias("timestamp"))
    return rk.forecast_axis(last, 300).select("user_id", "step", "forecast_ts")


@query(
    "fan_repair",
    t.with_ctes(
        *RISK_PARTS,
        """fan AS (SELECT *, mean AS median, mean - 5 + step % 10 AS low, mean + 3 - step % 7 AS high FROM pseudo)""",
        select="""SELECT f.station_code, step, round((mean + off) * 1048576) / 1048576 AS mean, round((least(low, median) + off) * 1048576) / 1048576 AS low,
          round((greatest(high, median) + off) * 1048576) / 1048576 AS high, round((last_level) * 1048576) / 1048576 AS last_level
          FROM fan f JOIN (SELECT station_code, last_level - median AS off FROM fan WHERE step = 1) o
            ON o.station_code = f.station_code""",
    ),
    binary=True,
)
def fan_repair(spark, sf_dir):
    mean, step = F.col("mean"), F.col("step")
    fan = _pseudo(spark, sf_dir).withColumns(
        {"median": mean, "low": mean - 5 + step % 10, "high": mean + 3 - step % 7}
    )
    return rk.repair_fan(fan)


@query(
    "residual_fan",
    t.with_ctes(
        *RISK_PARTS,
        select="""SELECT station_code, step, round((least(mean - 2 + step % 4, mean)) * 1048576) / 1048576 AS low,
                  round((greatest(mean + 2 - step % 5, mean)) * 1048576) / 1048576 AS high FROM pseudo""",
    ),
    binary=True,
)
def residual_fan(spark, sf_dir):
    low, high = rk.residual_fan(F.col("mean"), F.col("step") % 4 - 2.0, 2.0 - F.col("step") % 5)
    return _pseudo(spark, sf_dir).select(KEY, "step", low.alias("low"), high.alias("high"))


@query(
    "fan_table",
    t.with_ctes(
        *RISK_PARTS,
        select="""SELECT x.station_code, "timestamp", round((observed) * 1048576) / 1048576 AS observed, round((mean) * 1048576) / 1048576 AS mean,
          round((low) * 1048576) / 1048576 AS low, round((high) * 1048576) / 1048576 AS high, warning_level, danger_level, high_flood_level FROM (
            SELECT station_code, make_timestamp(hour * 3600000000) AS "timestamp", level AS observed, NULL AS mean,
                   NULL AS low, NULL AS high FROM pseudo_rows WHERE back <= 336
            UNION ALL SELECT station_code, make_timestamp(hour * 3600000000), NULL, mean, mean - 1, mean + 1 FROM pseudo) x
          LEFT JOIN catalogue c ON c.station_code = x.station_code""",
    ),
    binary=True,
)
def fan_table(spark, sf_dir):
    history = sr.as_readings(_series(spark, sf_dir).select(KEY, "hour", "level"))
    mean = F.col("mean")
    ahead = _pseudo(spark, sf_dir).withColumns(
        {"forecast_ts": hour_timestamp(F.col("hour")), "low": mean - 1, "high": mean + 1}
    )
    return rk.fan_table(history, ahead, t.catalogue(spark))


# --- model quality with the previous level as stand-in prediction -----------
@query(
    "mae",
    t.with_ctes(
        *STEPPED_PARTS,
        FEATURE_SQL,
        CODES_SQL,
        TRAIN_SQL,
        select="SELECT round((avg(abs(lag_1 - target))) * 1048576) / 1048576 AS mae, count(*) AS rows FROM train WHERE is_holdout",
    ),
    binary=True,
)
def mae(spark, sf_dir):
    rows = _training(spark, sf_dir).filter("is_holdout").withColumn("prediction", F.col("lag_1"))
    return fc.mean_absolute_error(rows)


@query(
    "residual_bands",
    t.with_ctes(
        *STEPPED_PARTS,
        FEATURE_SQL,
        CODES_SQL,
        TRAIN_SQL,
        select="""SELECT station_code, round(quantile_cont(target - lag_1, 0.1), 4) AS low_offset,
          round(quantile_cont(target - lag_1, 0.9), 4) AS high_offset FROM train GROUP BY 1 HAVING count(*) >= 100""",
    ),
)
def residual_bands(spark, sf_dir):
    return fc.residual_bands(_training(spark, sf_dir).withColumn("prediction", F.col("lag_1")))


@query(
    "station_quantiles",
    """SELECT CASE WHEN event_id % 10 < 9 THEN 'hot' ELSE CAST(user_id AS VARCHAR) END AS station_code, count(value) AS rows,
         round(quantile_cont(value, 0.1), 6) AS q10, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.9), 6) AS q90
       FROM events WHERE event_id % 50 <> 0 GROUP BY 1""",
)
def station_quantiles(spark, sf_dir):
    """Exact quantiles of every station at once, one of which has nine tenths of the rows."""
    code = F.when(F.col("event_id") % 10 < 9, "hot").otherwise(F.col("user_id").cast("string"))
    rows = t.table(spark, sf_dir, "events").select(code.alias(KEY), t.level_with_dropouts().alias("level"))
    found = exact_quantiles_by(rows, KEY, "level", [0.1, 0.5, 0.9])
    return found.select(KEY, "rows", *[F.get("quantiles", F.lit(i)).alias(f"q{q}") for i, q in enumerate((10, 50, 90))])


# --- models -----------------------------------------------------------------
# DuckDB cannot train the model: its SQL gives what is known beforehand (stations, rows,
# steps, times, last levels) and the invariants that must hold
TRAINED: dict[tuple[str, str], str] = {}


def _trained(spark, sf_dir):
    """Artefacts of one training job per application and data folder, loaded from its files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in TRAINED:
        out = f"{checkpoint_dir(spark)}/model-{uuid.uuid4().hex}"
        fc.run_training(spark, _training(spark, sf_dir), out)
        TRAINED[key] = out
    return TRAINED[key], fc.load_training(spark, TRAINED[key])


MODEL_PARTS = [*STEPPED_PARTS, FEATURE_SQL, CODES_SQL, TRAIN_SQL]
NEWEST_SQL = """trained_stations AS (SELECT station_code FROM train GROUP BY 1 HAVING count(*) >= 100),
newest_levels AS (SELECT station_code, max(hour) AS last_hour, arg_max(level, hour) AS last_level FROM series
  WHERE station_code IN (SELECT station_code FROM trained_stations) GROUP BY 1 HAVING count(*) >= 170)"""


@query(
    "gbt_train",
    t.with_ctes(*MODEL_PARTS, select="SELECT station_code, count(*) AS rows, 0 AS unfit FROM train WHERE is_holdout GROUP BY 1"),
)
def gbt_train(spark, sf_dir):
    """Hold-out rows per station of the global model, and those without a finite prediction."""
    out, _ = _trained(spark, sf_dir)
    held = spark.read.parquet(f"{out}/fitted").filter("is_holdout")
    unfit = F.count_if(~F.coalesce(F.abs("prediction") < 1e12, F.lit(False)))
    return held.groupBy(KEY).agg(F.count("*").alias("rows"), unfit.alias("unfit"))


@query(
    "training_report",
    t.with_ctes(
        *MODEL_PARTS,
        select="""SELECT (SELECT count(*) FROM train) AS rows, true AS has_error, count(*) AS bands, count(*) AS ordered_bands
          FROM (SELECT station_code FROM train GROUP BY 1 HAVING count(*) >= 100)""",
    ),
)
def training_report(spark, sf_dir):
    report, low_first = _trained(spark, sf_dir)[1].report, lambda b: b["low_offset"] <= b["high_offset"]
    return report.select(
        "rows",
        (F.col("val_mae_m") >= 0).alias("has_error"),
        F.size("band_offsets").alias("bands"),
        F.size(F.filter("band_offsets", low_first)).alias("ordered_bands"),
    )


def _forecast(spark, sf_dir, hours=72):
    trained = _trained(spark, sf_dir)[1]
    states = fc.forecast_states(_stepped(spark, sf_dir), t.catalogue(spark), trained.bands)
    return fc.recursive_forecast(trained.model, states, hours)


@query(
    "gbt_forecast",
    t.with_ctes(
        *MODEL_PARTS,
        NEWEST_SQL,
        select="""SELECT station_code, step, make_timestamp((last_hour + step) * 3600000000) AS forecast_ts,
          round(last_level * 1048576) / 1048576 AS last_level, true AS ordered
          FROM newest_levels, unnest(generate_series(1, 72)) AS s(step)""",
    ),
    binary=True,
)
def gbt_forecast(spark, sf_dir):
    ordered = (F.col("low") <= F.col("mean")) & (F.col("mean") <= F.col("high"))
    return _forecast(spark, sf_dir).select(KEY, "step", "forecast_ts", "last_level", ordered.alias("ordered"))


@query(
    "risk_snapshot",
    t.with_ctes(
        *MODEL_PARTS,
        NEWEST_SQL,
        select="""SELECT station_code, round(last_level * 1048576) / 1048576 AS last_level, true AS in_range, true AS adds_up
          FROM newest_levels""",
    ),
    binary=True,
)
def risk_snapshot(spark, sf_dir):
    """The real forecast through the risk score."""
    risk, parts = F.col("risk_score"), F.col("proximity") + F.col("crossing") + F.col("surge")
    return fc.risk_snapshot(_forecast(spark, sf_dir), t.catalogue(spark)).select(
        KEY,
        "last_level",
        risk.between(0, 100).alias("in_range"),
        (F.abs(risk - F.least(parts, F.lit(100.0))) < 1e-9).alias("adds_up"),
    )


# the model's own numbers, which SQL cannot give; tests hold them against plain Python
@query("gbt_fitted")
def gbt_fitted(spark, sf_dir):
    """Hold-out error and residual bands of every trained station."""
    out, trained = _trained(spark, sf_dir)
    held = spark.read.parquet(f"{out}/fitted").filter("is_holdout")
    errors = held.groupBy(KEY).agg(F.avg(F.abs(F.col("prediction") - F.col("target"))).alias("mae"), F.count("*").alias("rows"))
    return errors.join(trained.bands, KEY, "left")


@query("gbt_forecast_fan")
def gbt_forecast_fan(spark, sf_dir):
    return _forecast(spark, sf_dir).select(KEY, "step", "forecast_ts", "mean", "low", "high")


@query("risk_snapshot_scores")
def risk_snapshot_scores(spark, sf_dir):
    return fc.risk_snapshot(_forecast(spark, sf_dir), t.catalogue(spark))
