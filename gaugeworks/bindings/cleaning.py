"""Queries over normalisation, parsing, typing and the hourly transform."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from gaugeworks.bindings import tables as t
from gaugeworks.bindings.registry import query
from gaugeworks.catalogue import audit_catalogue, default_manifest
from gaugeworks.functions.levels import flood_alert, flood_status
from gaugeworks.functions.parsing import to_day
from gaugeworks.functions.text import clean_name, reading_key
from gaugeworks.operators import columns as cols
from gaugeworks.operators.enrich import absent_stations, join_stations, monitored_only, unresolved_names
from gaugeworks.operators.merge import dedup_readings, retain_days
from gaugeworks.plans.daily import merge_daily, postprocess, run_daily, with_daily_key
from gaugeworks.plans.hourly import enrich_readings, fetch_new, run_hourly, transform_readings
from gaugeworks.session import checkpoint_dir, cut_lineage
from gaugeworks.sources.published import daily_since


def provider_columns(spark, sf_dir):
    events = t.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        F.col("event_type").alias("Station Name "),
        F.col("ts").alias("Data Acquisition Time"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("River Water Level Telemetry Hourly (meter)"),
        (F.col("value") + 1).alias("Gauge Reading"),
        F.col("props").alias("Remarks"),
    )


@query(
    "normalize_columns",
    """SELECT event_id, event_type AS station_name, ts AS "timestamp",
              CASE WHEN event_id % 3 = 0 THEN value ELSE round(value + 1, 6) END AS water_level, props AS "Remarks"
       FROM events""",
)
def normalize_columns(spark, sf_dir):
    return cols.normalize_columns(provider_columns(spark, sf_dir))


@query(
    "canonical_projection",
    """SELECT event_type AS station_name, ts AS "timestamp",
              CASE WHEN event_id % 3 = 0 THEN value ELSE round(value + 1, 6) END AS water_level
       FROM events""",
)
def canonical_projection(spark, sf_dir):
    return cols.canonical(cols.order_columns(cols.normalize_columns(provider_columns(spark, sf_dir))))


def text_times(spark, sf_dir):
    rule = F.col("event_id") % 6
    text = (
        F.when(F.col("event_id") % 97 == 0, "not a date")
        .when(rule == 0, F.date_format("ts", "dd-MM-yyyy HH:mm"))
        .when(rule == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(rule == 2, F.date_format("ts", "d/M/yyyy H:mm"))
        .when(rule == 3, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(rule == 4, F.date_format("ts", "dd-MM-yyyy HH:mm:ss"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("Z")))
    )
    return t.table(spark, sf_dir, "events").select("event_id", text.alias("timestamp"))


TEXT_TIMES_SQL = """texts AS (
  SELECT event_id, event_id % 6 AS rule,
    CASE WHEN event_id % 97 = 0 THEN 'not a date'
         WHEN event_id % 6 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M')
         WHEN event_id % 6 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN event_id % 6 = 2 THEN strftime(ts, '%-d/%-m/%Y %-H:%M')
         WHEN event_id % 6 = 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
         WHEN event_id % 6 = 4 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z' END AS txt
  FROM events),
parsed AS (
  SELECT event_id, CASE
    WHEN txt LIKE '%+02:00' THEN try_strptime(replace(txt, '+02:00', ''), '%Y-%m-%dT%H:%M:%S') - INTERVAL 2 HOUR
    WHEN txt LIKE '%Z' THEN try_strptime(replace(txt, 'Z', ''), '%Y-%m-%d %H:%M:%S')
    ELSE coalesce(try_strptime(txt, '%d-%m-%Y %H:%M'), try_strptime(txt, '%Y-%m-%dT%H:%M:%S'),
                  try_strptime(txt, '%d/%m/%Y %H:%M'), try_strptime(txt, '%d-%m-%Y %H:%M:%S'))
         - INTERVAL 330 MINUTE END AS "timestamp"
  FROM texts)"""


@query("parse_timestamps", t.with_ctes(TEXT_TIMES_SQL, select="SELECT * FROM parsed"))
def parse_timestamps(spark, sf_dir):
    return cols.with_utc_timestamp(text_times(spark, sf_dir), "Asia/Kolkata")


@query(
    "drop_unparseable",
    t.with_ctes(TEXT_TIMES_SQL, select='SELECT * FROM parsed WHERE "timestamp" IS NOT NULL'),
)
def drop_unparseable(spark, sf_dir):
    return cols.drop_untimed(cols.with_utc_timestamp(text_times(spark, sf_dir), "Asia/Kolkata"))


@query(
    "coerce_numeric",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL
              ELSE value END AS water_level, CAST(NULL AS DOUBLE) AS latitude
       FROM events""",
)
def coerce_numeric(spark, sf_dir):
    text = (
        F.when(F.col("event_id") % 7 == 0, "N/A")
        .when(F.col("event_id") % 11 == 0, "1.0f")
        .when(F.col("event_id") % 13 == 0, "nan")
        .otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    )
    raw = t.table(spark, sf_dir, "events").select("event_id", text.alias("water_level"))
    return cols.coerce_doubles(raw, ["water_level", "latitude"])


@query(
    "report_rounding",
    """SELECT event_type AS station_code, round(avg(value), 2) AS two, round(avg(value), 3) AS three,
              round(avg(value), 4) AS four
       FROM events GROUP BY 1""",
)
def report_rounding(spark, sf_dir):
    mean = F.avg("value")
    return (
        t.table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("station_code"))
        .agg(F.round(mean, 2).alias("two"), F.round(mean, 3).alias("three"), F.round(mean, 4).alias("four"))
    )


def provider_daily(spark, sf_dir):
    """Orders as raw daily records, all text, French column names and values."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "Donnée brute")
        .when(F.col("o_orderstatus") == "F", "Donnée validée")
        .otherwise("Inconnue")
    )
    level = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("code_station_text"),
        F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("code_station"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_obs_elab"),
        level.alias("resultat_obs_elab"),
        status.alias("libelle_statut"),
        F.concat(F.lit("P"), F.col("o_orderkey").cast("string")).alias("code_site"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise("n.a.").alias("Remark"),
    )


DAILY_SQL = """daily AS (
  SELECT CAST(o_custkey AS DOUBLE) AS code_station_text, 'S' || o_custkey AS station_code,
         CAST(o_orderdate AS DATE) AS record_date,
         CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS water_level_mm,
         CASE o_orderstatus WHEN 'O' THEN 'raw' WHEN 'F' THEN 'validated' ELSE 'Inconnue' END AS validation_status,
         CASE o_orderstatus WHEN 'O' THEN 'Donnée brute' WHEN 'F' THEN 'Donnée validée' ELSE 'Inconnue' END AS raw_status,
         'P' || o_orderkey AS location_code,
         CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'n.a.' END AS "Remark", o_orderkey
  FROM orders)"""


@query(
    "type_inference",
    t.with_ctes(
        DAILY_SQL,
        select="""SELECT code_station_text, station_code AS code_station, record_date AS date_obs_elab,
          water_level_mm AS resultat_obs_elab, raw_status AS libelle_statut, location_code AS code_site, "Remark"
          FROM daily""",
    ),
)
def type_inference(spark, sf_dir):
    return cols.convert_types(provider_daily(spark, sf_dir))


@query(
    "daily_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS record_date
       FROM orders""",
)
def daily_dates(spark, sf_dir):
    text = (
        F.when(F.col("o_orderkey") % 97 == 0, "not a date")
        .when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "dd-MM-yyyy HH:mm"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return t.table(spark, sf_dir, "orders").select("o_orderkey", to_day(text).alias("record_date"))


@query(
    "category_translate",
    t.with_ctes(DAILY_SQL, select="SELECT location_code, validation_status FROM daily"),
)
def category_translate(spark, sf_dir):
    renamed = cols.to_english(provider_daily(spark, sf_dir).select("code_site", "libelle_statut"))
    return cols.translate_categories(renamed)


@query(
    "flood_alert",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice / 50 END > 6000, false)
              AS flood_alert FROM orders""",
)
def flood_alerts(spark, sf_dir):
    level = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_totalprice") / 50)
    return t.table(spark, sf_dir, "orders").select("o_orderkey", flood_alert(level).alias("flood_alert"))


@query(
    "rename_roundtrip",
    t.with_ctes(
        DAILY_SQL,
        select="""SELECT station_code AS code_station, location_code AS code_site, raw_status AS libelle_statut,
                  strftime(record_date, '%Y-%m-%d') AS date_obs_elab FROM daily""",
    ),
)
def rename_roundtrip(spark, sf_dir):
    own = provider_daily(spark, sf_dir).select("code_station", "code_site", "libelle_statut", "date_obs_elab")
    return cols.to_provider(cols.to_english(own))


@query(
    "daily_postprocess",
    t.with_ctes(
        DAILY_SQL,
        select="""SELECT station_code, record_date, water_level_mm, coalesce(water_level_mm > 6000, false) AS flood_alert,
          validation_status, location_code, code_station_text, "Remark" FROM daily""",
    ),
)
def daily_postprocess(spark, sf_dir):
    return postprocess(provider_daily(spark, sf_dir))


@query(
    "daily_cursor",
    t.with_ctes(
        DAILY_SQL,
        select="SELECT station_code, record_date, location_code FROM daily WHERE record_date >= DATE '1999-01-01'",
    ),
)
def daily_cursor(spark, sf_dir):
    landed = cols.to_english(provider_daily(spark, sf_dir).select("code_station", "date_obs_elab", "code_site"))
    return daily_since(landed, date(1999, 1, 1))


@query(
    "daily_merge",
    t.with_ctes(
        DAILY_SQL,
        """existing AS (SELECT * FROM daily WHERE record_date <= DATE '1999-06-30'),
fetched AS (SELECT * FROM daily WHERE record_date >= DATE '1999-06-01'),
keyed AS (SELECT *, station_code || '_' || record_date || '_' || coalesce(CAST(water_level_mm AS VARCHAR), '') AS k
          FROM fetched),
fresh AS (SELECT * FROM keyed WHERE k NOT IN (
          SELECT station_code || '_' || record_date || '_' || coalesce(CAST(water_level_mm AS VARCHAR), '') FROM existing)),
merged AS (SELECT * FROM existing UNION ALL SELECT * EXCLUDE (k) FROM fresh)""",
        select="""SELECT station_code, record_date, water_level_mm, coalesce(water_level_mm > 6000, false) AS flood_alert,
          validation_status, location_code FROM merged""",
    ),
)
def daily_merge(spark, sf_dir):
    wanted = ["code_station", "date_obs_elab", "resultat_obs_elab", "libelle_statut", "code_site"]
    landed = provider_daily(spark, sf_dir).select(*wanted)
    existing = cols.to_english(landed.filter(F.col("date_obs_elab") <= "1999-06-30")).withColumn(
        "record_date", to_day(F.col("record_date"))
    )
    halves = [landed.filter(F.col("code_site").endswith("1")), landed.filter(~F.col("code_site").endswith("1"))]
    return merge_daily(existing, halves, date(1999, 6, 1))


@query(
    "daily_run",
    t.with_ctes(
        DAILY_SQL,
        select="""SELECT station_code, record_date, water_level_mm, coalesce(water_level_mm > 6000, false) AS flood_alert,
          validation_status, location_code FROM daily""",
    ),
)
def daily_run(spark, sf_dir):
    """The job on its own table: first landing, a run with nothing due, then the rest in two pages."""
    wanted = ["code_station", "date_obs_elab", "resultat_obs_elab", "libelle_statut", "code_site"]
    out = f"{checkpoint_dir(spark)}/daily-{uuid.uuid4().hex}"
    landed = provider_daily(spark, sf_dir).select(*wanted)
    halves = [landed.filter(F.col("code_site").endswith("1")), landed.filter(~F.col("code_site").endswith("1"))]
    run_daily(spark, [landed.filter(F.col("date_obs_elab") <= "1995-06-30")], out, date(1999, 1, 1), {"title": "daily"})
    for as_of in (date(1995, 7, 1), date(1999, 7, 1)):
        published = run_daily(spark, halves, out, as_of, {"title": "daily"})
    return published


@query(
    "daily_key",
    t.with_ctes(
        DAILY_SQL,
        select="""SELECT location_code, station_code || '_' || strftime(record_date, '%Y-%m-%d') || '_' ||
          coalesce(CAST(CAST(floor(water_level_mm) AS BIGINT) AS VARCHAR) || '.0', '') AS daily_key FROM daily""",
    ),
)
def daily_keys(spark, sf_dir):
    whole = provider_daily(spark, sf_dir).withColumn(
        "resultat_obs_elab", F.split_part(F.col("resultat_obs_elab"), F.lit("."), F.lit(1))
    )
    return with_daily_key(cols.to_english(whole)).select("location_code", "daily_key")


@query(
    "clean_name_join",
    t.with_ctes(
        t.READINGS_SQL,
        t.CATALOGUE_SQL,
        select="""SELECT event_id, coalesce(c.station_code, '  ' || upper(r.station_code) || chr(9) || ' ') AS station_code,
          coalesce(c.station_name, '  ' || upper(r.station_code) || chr(9) || ' ') AS station_name, basin_name,
          warning_level, danger_level, high_flood_level, coalesce(CASE WHEN event_id % 3 = 0 THEN 1.5 END, latitude) AS latitude,
          longitude
          FROM readings r LEFT JOIN catalogue c ON c.station_code = r.station_code""",
    ),
)
def clean_name_join(spark, sf_dir):
    odd = t.readings(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("  "), F.upper("station_code"), F.lit("\t ")).alias("station_name"),
        F.when(F.col("event_id") % 3 == 0, F.lit(1.5)).alias("latitude"),
    )
    return join_stations(odd, t.catalogue(spark))


@query(
    "name_normalisation",
    """SELECT DISTINCT lower(o_orderpriority) || ' ' || lower(c_name) AS cleaned
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def name_normalisation(spark, sf_dir):
    orders, customer = t.table(spark, sf_dir, "orders"), t.table(spark, sf_dir, "customer")
    spaced = F.concat(F.lit(" \t"), "o_orderpriority", F.lit(" \n  "), "c_name", F.lit("  "))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.select(clean_name(spaced).alias("cleaned")).distinct()


@query(
    "unresolved_names",
    t.with_ctes(
        t.CATALOGUE_SQL,
        select="""SELECT DISTINCT event_type AS station_name FROM events
                  WHERE event_type NOT IN (SELECT station_code FROM catalogue)""",
    ),
)
def unresolved(spark, sf_dir):
    named = t.readings(spark, sf_dir).select(F.col("station_code").alias("station_name"))
    return unresolved_names(named, t.catalogue(spark))


@query(
    "absent_stations",
    t.with_ctes(
        t.USER_READINGS_SQL,
        t.USER_CATALOGUE_SQL,
        select="""SELECT station_code, station_name, basin_name FROM user_catalogue
                  WHERE station_code NOT IN (SELECT station_code FROM user_readings)""",
    ),
)
def absent(spark, sf_dir):
    return absent_stations(t.user_readings(spark, sf_dir), t.user_catalogue(spark, sf_dir))


@query(
    "monitored_rows",
    t.with_ctes(
        t.CATALOGUE_SQL,
        select="""SELECT event_id, CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_type END AS station_name
          FROM events WHERE event_id % 41 = 0 OR event_type IN (SELECT station_code FROM catalogue)""",
    ),
)
def monitored_rows(spark, sf_dir):
    named = t.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 41 != 0, F.col("event_type")).alias("station_name")
    )
    return monitored_only(named, t.catalogue(spark))


@query(
    "flood_status",
    t.with_ctes(
        t.READINGS_SQL, t.CATALOGUE_SQL, t.ENRICHED_SQL, select="SELECT event_id, station_code, flood_status FROM enriched"
    ),
)
def status_of_readings(spark, sf_dir):
    return t.enriched(spark, sf_dir).select("event_id", "station_code", "flood_status")


@query(
    "flood_status_missing_thresholds",
    f"""SELECT event_id, {t.STATUS_SQL} AS flood_status FROM (
          SELECT event_id, value AS water_level, CASE WHEN event_id % 2 = 0 THEN CAST(35 AS DOUBLE) END AS warning_level,
                 CASE WHEN event_id % 3 = 0 THEN CAST(75 AS DOUBLE) END AS danger_level,
                 CASE WHEN event_id % 5 <> 0 THEN CAST(120 AS DOUBLE) END AS high_flood_level FROM events)""",
)
def status_missing_thresholds(spark, sf_dir):
    known = {"warning": F.when(F.col("event_id") % 2 == 0, 35.0), "danger": F.when(F.col("event_id") % 3 == 0, 75.0)}
    high = F.when(F.col("event_id") % 5 != 0, 120.0)
    return t.table(spark, sf_dir, "events").select(
        "event_id", flood_status(F.col("value"), known["warning"], known["danger"], high).alias("flood_status")
    )


@query(
    "dedup_key",
    t.with_ctes(
        t.READINGS_SQL,
        select="""SELECT event_id, station_code || '_' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S+0000') || '_' ||
          coalesce(printf('%.4f', water_level / 7), '') AS dedup_key FROM readings""",
    ),
)
def dedup_keys(spark, sf_dir):
    r = t.readings(spark, sf_dir)
    key = reading_key(r.station_code, r.timestamp, r.water_level / 7)
    return r.select("event_id", key.alias("dedup_key"))


@query(
    "hourly_transform",
    t.with_ctes(t.RAW_SQL, t.CATALOGUE_SQL, t.TRANSFORMED_SQL, select=f"SELECT {t.READING_LIST} FROM transformed"),
)
def hourly_transform(spark, sf_dir):
    return transform_readings(t.raw_readings(spark, sf_dir), t.catalogue(spark), "Asia/Kolkata")


@query(
    "hourly_transform_sorted",
    t.with_ctes(
        t.RAW_SQL,
        t.CATALOGUE_SQL,
        t.TRANSFORMED_SQL,
        select="""SELECT station_code, "timestamp", count(*) AS readings FROM transformed
                  GROUP BY 1, 2 ORDER BY 1, 2""",
    ),
)
def hourly_transform_sorted(spark, sf_dir):
    done = hourly_transform(spark, sf_dir)
    return done.groupBy("station_code", "timestamp").agg(F.count("*").alias("readings")).orderBy(
        "station_code", "timestamp"
    )


@query(
    "hourly_merge",
    t.with_ctes(
        t.RAW_SQL,
        t.CATALOGUE_SQL,
        t.TRANSFORMED_SQL,
        """old AS (SELECT *, 0 AS batch FROM transformed WHERE "timestamp" <= TIMESTAMP '2024-01-12'),
landed AS (SELECT *, 1 AS batch FROM transformed
           WHERE basin_name IS NOT NULL AND "timestamp" > TIMESTAMP '2024-01-10' AND "timestamp" <= TIMESTAMP '2024-01-28'),
old_and_new AS (SELECT * FROM old UNION ALL SELECT * FROM landed),
one AS (SELECT * FROM old_and_new QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY batch DESC) = 1)""",
        select=f"""SELECT {t.READING_LIST} FROM one
          WHERE "timestamp" >= (SELECT max("timestamp") FROM one) - INTERVAL 20 DAY""",
    ),
)
def hourly_merge(spark, sf_dir):
    raw, stations = t.raw_readings(spark, sf_dir), t.catalogue(spark)
    published = transform_readings(raw, stations, "Asia/Kolkata").filter(F.col("timestamp") <= "2024-01-12")
    window = (datetime(2024, 1, 10), datetime(2024, 1, 28))
    fresh = fetch_new(raw, stations, *window, "Asia/Kolkata")
    merged = dedup_readings(published, enrich_readings(cols.drop_untimed(fresh), stations))
    return retain_days(cut_lineage(merged), 20)


@query(
    "hourly_run",
    t.with_ctes(
        t.RAW_SQL,
        t.CATALOGUE_SQL,
        t.TRANSFORMED_SQL,
        """landed AS (SELECT * FROM transformed WHERE basin_name IS NOT NULL
           AND "timestamp" > TIMESTAMP '2024-01-03' AND "timestamp" <= TIMESTAMP '2024-01-28')""",
        select=f"""SELECT DISTINCT {t.READING_LIST} FROM landed
          WHERE "timestamp" >= (SELECT max("timestamp") FROM landed) - INTERVAL 20 DAY""",
    ),
)
def hourly_run(spark, sf_dir):
    """The job on its own dataset: a run, the same run again with nothing new, a later run."""
    raw, stations = t.raw_readings(spark, sf_dir), t.catalogue(spark)
    root = f"{checkpoint_dir(spark)}/hourly-{uuid.uuid4().hex}"
    for end in (datetime(2024, 1, 15), datetime(2024, 1, 15), datetime(2024, 1, 28)):
        done = run_hourly(
            spark, raw, stations, default_manifest(spark), root, end, datetime(2024, 1, 3), {}, "provider", retention_days=20, keep_versions=2
        )
    return done.readings


@query(
    "catalogue_audit",
    """WITH c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS code,
           CASE WHEN c_custkey % 11 = 0 THEN '  ' ELSE CAST(c_custkey AS VARCHAR) END AS station_code,
           CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS source_name,
           CASE WHEN c_custkey % 7 = 0 THEN 'other' WHEN c_custkey % 2 = 0 THEN 'manual' ELSE 'telemetry' END AS kind,
           c_acctbal / 100 AS latitude, c_acctbal / 50 AS longitude, 20 AS wl, 30 + c_custkey % 40 AS dl, 60 AS hfl
         FROM customer)
       SELECT c_custkey, concat_ws('; ',
           CASE WHEN trim(station_code) = '' THEN 'empty station_code' END,
           CASE WHEN coalesce(trim(source_name), '') = '' THEN 'empty source_station_name' END,
           CASE WHEN kind NOT IN ('telemetry', 'manual') THEN 'unknown kind' END,
           CASE WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude out of range' END,
           CASE WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude out of range' END,
           CASE WHEN NOT (wl <= dl AND dl <= hfl) THEN 'thresholds not ascending' END,
           CASE WHEN code <> station_code THEN 'key differs from station_code' END) AS violations
       FROM c""",
)
def catalogue_audit(spark, sf_dir):
    key = F.col("c_custkey")
    entries = t.table(spark, sf_dir, "customer").select(
        "c_custkey",
        key.cast("string").alias("code"),
        F.when(key % 11 == 0, "  ").otherwise(key.cast("string")).alias("station_code"),
        F.when(key % 13 != 0, F.col("c_name")).alias("source_station_name"),
        F.when(key % 7 == 0, "other").when(key % 2 == 0, "manual").otherwise("telemetry").alias("kind"),
        (F.col("c_acctbal") / 100).alias("latitude"),
        (F.col("c_acctbal") / 50).alias("longitude"),
        F.lit(20.0).alias("warning_level"),
        (30.0 + key % 40).alias("danger_level"),
        F.lit(60.0).alias("high_flood_level"),
    )
    return audit_catalogue(entries, "code").select("c_custkey", F.array_join("violations", "; ").alias("violations"))
