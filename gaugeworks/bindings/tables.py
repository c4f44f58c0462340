"""The driver tables seen as gauge data, in Spark and in SQL.

``events`` are the readings: a station per event type (or per user), the event
value as level, with dropouts set by rule. The catalogue names four of the five
types; ``customer`` with nation and region is a larger catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gaugeworks.catalogue import STATION_FIELDS, make_catalogue
from gaugeworks.functions.levels import flood_status
from gaugeworks.operators.enrich import join_stations
from gaugeworks.session import pin_utc

STATIONS = [
    ("click", "Gauge at Click", "Click", "North", "telemetry", 60.0, 120.0, 200.0, 10.5, 70.25),
    ("view", "Gauge at View", "View", "North", "manual", 50.0, 200.0, 200.0, 11.5, 71.25),
    ("purchase", "Gauge at Purchase", "Purchase", "South", "telemetry", 30.0, 40.0, 50.0, 12.5, 72.25),
    ("signup", "Gauge at Signup", "Signup", "South", "manual", 10.0, 15.0, 20.0, 13.5, 73.25),
]
DIGITS = 6
# means of decimal levels can lie exactly between two decimals, which engines
# round either way, but never between two steps of a binary grid
GRID = 2.0**20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def level_with_dropouts() -> Column:
    """Event value, every 50th missing."""
    return F.when(F.col("event_id") % 50 != 0, F.col("value"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station per event type, ``event_id`` as ingest sequence."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("station_code"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        level_with_dropouts().alias("water_level"),
    )


def user_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station per user, timestamps cut to the hour so that they repeat."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("station_code"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp"),
        level_with_dropouts().alias("water_level"),
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider shape: odd names, day-first text times, levels as text in two columns."""
    name = F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
    time = F.when(F.col("event_id") % 97 == 0, "not a date").otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm"))
    level = F.when(F.col("event_id") % 50 != 0, F.col("value").cast("string")).otherwise("N/A")
    manual = F.col("event_type").isin("view", "signup")
    return table(spark, sf_dir, "events").select(
        "event_id",
        name.alias("Station"),
        time.alias("Data Acquisition Time"),
        F.when(~manual, level).alias("River Water Level Telemetry Hourly (meter)"),
        F.when(manual, level).alias("River Water Level Manual Hourly (meter)"),
        F.col("props").alias("Remarks"),
    )


def catalogue(spark: SparkSession) -> DataFrame:
    return make_catalogue(pin_utc(spark), [dict(zip(STATION_FIELDS, row)) for row in STATIONS])


def user_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station per customer, basin from the region, thresholds by rule."""
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("position"),
            F.col("c_custkey").cast("string").alias("station_code"),
            F.col("c_name").alias("station_name"),
            F.lower("c_name").alias("source_station_name"),
            F.lower("r_name").alias("basin_name"),
            F.when(F.col("c_custkey") % 2 == 0, "manual").otherwise("telemetry").alias("kind"),
            (20.0 + F.col("c_custkey") % 20).alias("warning_level"),
            (50.0 + F.col("c_custkey") % 20).alias("danger_level"),
            (90.0 + F.col("c_custkey") % 20).alias("high_flood_level"),
            (F.col("c_nationkey") * 1.5).alias("latitude"),
            (F.col("c_nationkey") * 2.5).alias("longitude"),
            F.array().cast("array<string>").alias("match_aliases"),
        )
    )


def enrich(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Readings of the five types with catalogue columns and status, sequence kept."""
    joined = join_stations(df.withColumn("station_name", F.col("station_code")), catalogue(spark))
    return joined.withColumn(
        "flood_status",
        flood_status(*[F.col(c) for c in ("water_level", "warning_level", "danger_level", "high_flood_level")]),
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(readings(spark, sf_dir), spark)


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source resource per region, kind and five-year range, as the suppliers have them."""
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    start = (1990 + 5 * (F.col("s_suppkey") % 8)).cast("int")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .groupBy(
            F.lower("r_name").alias("basin"),
            F.when(F.col("s_suppkey") % 3 == 0, "manual").otherwise("telemetry").alias("kind"),
            start.alias("start_year"),
        )
        .agg(F.min("s_name").alias("resource_id"))
        .select(
            "basin",
            "kind",
            F.format_string("(%d - %d)", "start_year", F.col("start_year") + 4).alias("time_range"),
            "resource_id",
            "start_year",
            (F.col("start_year") + 4).alias("end_year"),
        )
    )


def tidy(df: DataFrame, binary: bool = False) -> DataFrame:
    """Comparable output: rounded doubles, 64-bit integers, zone-free timestamps."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c * GRID) / GRID if binary else F.round(c, DIGITS)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# --- the same bindings as SQL common table expressions ----------------------
def on_grid(expression: str, name: str) -> str:
    return f"round(({expression}) * {GRID:.0f}) / {GRID:.0f} AS {name}"


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _values(rows: list[tuple]) -> str:
    def literal(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)" if isinstance(v, float) else str(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


LEVEL_SQL = "CASE WHEN event_id % 50 <> 0 THEN value END"
READINGS_SQL = f"""readings AS (
  SELECT event_id, event_type AS station_code, ts AS "timestamp", {LEVEL_SQL} AS water_level FROM events)"""
USER_READINGS_SQL = f"""user_readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_code, date_trunc('hour', ts) AS "timestamp",
         {LEVEL_SQL} AS water_level FROM events)"""
CATALOGUE_SQL = f"""catalogue(position, {", ".join(STATION_FIELDS)}) AS (
  VALUES {_values([(i, *row) for i, row in enumerate(STATIONS)])})"""
STATUS_SQL = """CASE WHEN water_level < warning_level THEN 'NORMAL'
    WHEN water_level >= warning_level AND water_level < danger_level THEN 'WARNING'
    WHEN water_level >= danger_level AND water_level < high_flood_level THEN 'DANGER'
    WHEN water_level >= high_flood_level THEN 'HIGH_FLOOD_EXCEEDED' END"""
ENRICHED_SQL = f"""enriched AS (
  SELECT event_id, r.station_code, coalesce(c.station_name, r.station_code) AS station_name, c.basin_name,
         "timestamp", water_level, {STATUS_SQL} AS flood_status,
         warning_level, danger_level, high_flood_level, latitude, longitude
  FROM readings r LEFT JOIN catalogue c ON c.station_code = r.station_code)"""
USER_CATALOGUE_SQL = """user_catalogue AS (
  SELECT c_custkey AS position, CAST(c_custkey AS VARCHAR) AS station_code, c_name AS station_name,
         lower(c_name) AS source_station_name,
         lower(r_name) AS basin_name,
         CASE WHEN c_custkey % 2 = 0 THEN 'manual' ELSE 'telemetry' END AS kind,
         CAST(20 + c_custkey % 20 AS DOUBLE) AS warning_level,
         CAST(50 + c_custkey % 20 AS DOUBLE) AS danger_level,
         CAST(90 + c_custkey % 20 AS DOUBLE) AS high_flood_level,
         c_nationkey * CAST(1.5 AS DOUBLE) AS latitude, c_nationkey * CAST(2.5 AS DOUBLE) AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
MANIFEST_SQL = """manifest AS (
  SELECT lower(r_name) AS basin, CASE WHEN s_suppkey % 3 = 0 THEN 'manual' ELSE 'telemetry' END AS kind,
         '(' || (1990 + 5 * (s_suppkey % 8)) || ' - ' || (1994 + 5 * (s_suppkey % 8)) || ')' AS time_range,
         min(s_name) AS resource_id,
         1990 + 5 * (s_suppkey % 8) AS start_year, 1994 + 5 * (s_suppkey % 8) AS end_year
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3, 5, 6)"""
RAW_SQL = """raw AS (
  SELECT event_id, '  ' || upper(event_type) || ' ' AS station_name,
         CASE WHEN event_id % 97 = 0 THEN 'not a date' ELSE strftime(ts, '%d-%m-%Y %H:%M') END AS time_text,
         CASE WHEN event_id % 50 <> 0 THEN CAST(value AS VARCHAR) ELSE 'N/A' END AS level_text,
         event_type, props
  FROM events)"""
TRANSFORMED_SQL = f"""parsed AS (
  SELECT event_id, station_name AS raw_name, lower(trim(station_name)) AS clean,
         try_strptime(time_text, '%d-%m-%Y %H:%M') - INTERVAL 330 MINUTE AS "timestamp",
         TRY_CAST(level_text AS DOUBLE) AS water_level
  FROM raw),
transformed AS (
  SELECT event_id, coalesce(c.station_code, raw_name) AS station_code,
         coalesce(c.station_name, raw_name) AS station_name, c.basin_name, "timestamp", water_level,
         {STATUS_SQL} AS flood_status, warning_level, danger_level, high_flood_level, latitude, longitude,
         coalesce(c.station_code, raw_name) || '_' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S+0000') || '_' ||
           coalesce(printf('%.4f', water_level), '') AS dedup_key
  FROM parsed LEFT JOIN catalogue c ON lower(c.source_station_name) = clean
  WHERE "timestamp" IS NOT NULL)"""
READING_LIST = """station_code, station_name, basin_name, "timestamp", round(water_level, 6) AS water_level,
  flood_status, warning_level, danger_level, high_flood_level, latitude, longitude, dedup_key"""
