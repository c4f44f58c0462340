"""The daily job: provider pages to the published daily table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.functions.levels import flood_alert
from gaugeworks.functions.parsing import to_day, to_double
from gaugeworks.functions.text import daily_key
from gaugeworks.operators import columns as cols
from gaugeworks.operators.merge import new_rows_only, union_tables
from gaugeworks.operators.metadata import daily_metadata
from gaugeworks.schema import FLOOD_ALERT_MM, FRENCH_CATEGORIES
from gaugeworks.sources.publish import VersionedDataset, write_csv, write_json, write_parquet
from gaugeworks.sources.published import daily_since, update_decision

#: What a daily table has before its first run.
DAILY_KEYS = "station_code string, record_date date, water_level_mm double"


def with_daily_key(df: DataFrame) -> DataFrame:
    """Key from provider or English column names."""
    types = dict(df.dtypes)

    def pick(*names: str) -> str:
        return next(n for n in names if n in types)

    day, level = pick("date_obs_elab", "record_date"), pick("resultat_obs_elab", "water_level_mm")
    return df.withColumn(
        "daily_key",
        daily_key(
            F.col(pick("code_station", "station_code")),
            to_day(F.col(day), types[day]),
            to_double(F.col(level), types[level]),
        ),
    )


def new_daily_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows not yet published, by daily key."""
    return new_rows_only(with_daily_key(existing), with_daily_key(new), "daily_key").drop("daily_key")


def postprocess(
    df: DataFrame,
    mappings: dict[str, dict[str, str]] = FRENCH_CATEGORIES,
    threshold: float = FLOOD_ALERT_MM,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Types, names, categories, alert flag, order.

    Pass ``types`` to skip the inference pass when the landing schema is known.
    """
    df = cols.to_english(cols.convert_types(df, types))
    df = cols.translate_categories(df, mappings)
    if "water_level_mm" in df.columns:
        df = df.withColumn("flood_alert", flood_alert(F.col("water_level_mm"), threshold))
    return cols.order_daily(df).orderBy("record_date", "station_code")


def merge_daily(
    existing: DataFrame,
    pages: list[DataFrame],
    start: date,
    mappings: dict[str, dict[str, str]] = FRENCH_CATEGORIES,
    threshold: float = FLOOD_ALERT_MM,
    types: dict[str, str] | None = None,
) -> DataFrame:
    """Published rows plus truly new ones, postprocessed (C4 between its reads and writes).

    Types are inferred on the landed pages alone, in one pass, and applied to both sides.
    """
    fetched = union_tables([daily_since(cols.to_english(page), start) for page in pages])
    types = cols.infer_text_types(fetched) if types is None else types
    typed, held = cols.convert_types(fetched, types), cols.convert_types(existing, types)
    return postprocess(union_tables([held, new_daily_rows(held, typed)]), mappings, threshold, {})


def run_daily(
    spark: SparkSession,
    pages: list[DataFrame],
    out: str,
    as_of: date,
    descriptors: dict[str, str],
    region: str = "france",
    mappings: dict[str, dict[str, str]] = FRENCH_CATEGORIES,
    threshold: float = FLOOD_ALERT_MM,
    keep_versions: int = 3,
) -> DataFrame:
    """Whole daily run on the table under ``out`` (C4); returns what is published after it.

    The merge is written once, as a new version; CSV and metadata read that, and the
    pointer moves to the version when all of it is there. A table that is current, or a
    run that fails, leaves the published version as it is.
    """
    dataset = VersionedDataset(spark, out)

    def published() -> DataFrame:
        current = dataset.current()
        return spark.read.parquet(f"{current}/parquet") if current else spark.createDataFrame([], DAILY_KEYS)

    existing = published()
    decision = update_decision(existing, as_of, region).first()
    if not decision["should_update"]:
        return existing
    version = dataset.stage()
    write_parquet(merge_daily(existing, pages, decision["start_date"], mappings, threshold), f"{version}/parquet")
    merged = spark.read.parquet(f"{version}/parquet")
    write_csv(merged, f"{version}/csv")
    write_json(daily_metadata(merged, descriptors), f"{version}/metadata")
    dataset.publish(version)
    dataset.prune(keep_versions)
    return published()
