"""The landing zone: folders of chosen resources, payloads as variants, station names at the scan.

A zone has ``basin=.../time_range=...`` folders. Which of them a run needs is decided from
the manifest before any file is opened: the folders are listed, chosen ones are read as
explicit paths with a given schema, and nothing else of the zone is touched.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from gaugeworks.schema import FIELD_ALIASES, PAYLOAD_KEYS
from gaugeworks.sources.published import path_exists
from gaugeworks.sources.resources import resource_stations

KEYS = ["basin", "time_range"]
PAYLOAD_FILES = "value string, basin string, time_range string"
#: Names that are sent to a scan as literals; more of them become a join.
FEW_NAMES = 1000


def _folders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """``key=value`` folders of a path by value."""
    if not path_exists(spark, path):
        return {}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in held if status.isDirectory()]
    return {unquote(n[len(key) + 1 :]): f"{path}/{n}" for n in names if n.startswith(f"{key}=")}


def resource_folders(spark: SparkSession, zone: str, chosen: DataFrame) -> list[str]:
    """Folders of the chosen manifest rows that exist (S8, S9); no file is opened.

    The manifest is configuration: a row per source resource.
    """
    wanted: dict[str, set[str]] = {}
    for row in chosen.select(*KEYS).distinct().collect():
        wanted.setdefault(row["basin"], set()).add(row["time_range"])
    basins = _folders(spark, zone.rstrip("/"), "basin")
    return sorted(
        folder
        for basin in basins.keys() & wanted.keys()
        for years, folder in _folders(spark, basins[basin], "time_range").items()
        if years in wanted[basin]
    )


def _payload_texts(spark: SparkSession, zone: str, folders: list[str], lines: bool) -> DataFrame:
    """Text of each payload: a file, or with ``lines`` a line that is not blank."""
    if not folders:
        return spark.createDataFrame([], PAYLOAD_FILES)
    texts = spark.read.schema(PAYLOAD_FILES).option("basePath", zone).text(folders, wholetext=not lines)
    return texts.filter(F.trim("value") != "") if lines else texts


def read_payload_variants(spark: SparkSession, zone: str, folders: list[str], lines: bool = False) -> DataFrame:
    """One row per payload: ``basin, time_range, payload``; NULL where one is no JSON.

    A payload is a file, or with ``lines`` a line: files of many payloads spare a large zone
    the time that each file costs. The text is parsed to a variant, so no pass infers a
    schema and payloads may differ in shape and types.
    """
    texts = _payload_texts(spark, zone, folders, lines)
    return texts.select(*KEYS, F.try_parse_json("value").alias("payload"))


def _held(payload: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(payload, path, kind)


def variant_records(payloads: DataFrame) -> DataFrame:
    """Record objects of each payload (S2): ``basin, time_range, record``.

    A payload with ``result`` is read inside it only; of the known keys the first that holds
    a list counts; a bare list is a list of records; list items that are no objects go.
    """
    inside = F.coalesce(_held(F.col("payload"), "$.result", "variant"), F.col("payload"))
    lists = [_held(F.col("_inside"), path, "array<variant>") for path in [*[f"$.{k}" for k in PAYLOAD_KEYS], "$"]]
    return (
        payloads.withColumn("_inside", inside)
        .select(*KEYS, F.explode(F.coalesce(*lists)).alias("record"))
        .filter(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")))
    )


def typed_records(records: DataFrame, aliases: dict[str, list[str]] = FIELD_ALIASES) -> DataFrame:
    """The published raw columns of variant records, as text (P1 on variants).

    A field counts under any accepted spelling; of several the first by name that is not
    null. Nested objects are no values of a column.
    """
    fields = F.map_entries(_held(F.col("record"), "$", "map<string,variant>"))
    entries = F.transform(
        F.filter(fields, lambda e: ~F.startswith(F.schema_of_variant(e["value"]), F.lit("OBJECT"))),
        lambda e: F.struct(F.lower(F.trim(e["key"])).alias("name"), _held(e["value"], "$", "string").alias("text")),
    )
    known = records.withColumn("_fields", entries)

    def column(standard: str) -> Column:
        mine = F.filter("_fields", lambda e: e["name"].isin(aliases[standard]) & e["text"].isNotNull())
        return F.try_element_at(F.transform(mine, lambda e: e["text"]), F.lit(1)).alias(standard)

    return known.select(*KEYS, *[column(standard) for standard in aliases])


def landed_records(
    spark: SparkSession, zone: str, chosen: DataFrame, report: Observation | None = None, lines: bool = False
) -> DataFrame:
    """Raw rows of the chosen resources of a zone of JSON payloads, all columns text.

    Payloads that are no JSON have no records; with ``report`` they are counted as ``bad_payloads``.
    A file of no bytes is no payload. With ``lines`` every line of a file is a payload.
    """
    payloads = read_payload_variants(spark, zone, resource_folders(spark, zone, chosen), lines)
    if report is not None:
        payloads = payloads.observe(report, F.count_if(F.col("payload").isNull()).alias("bad_payloads"))
    return typed_records(variant_records(payloads))


def bad_payloads(spark: SparkSession, zone: str, chosen: DataFrame, lines: bool = False) -> DataFrame:
    """Files of the chosen resources that are no JSON, or with ``lines`` hold a payload that is none."""
    folders = resource_folders(spark, zone, chosen)
    if not folders:
        return spark.createDataFrame([], "file string")
    bad = _payload_texts(spark, zone, folders, lines).filter(F.try_parse_json("value").isNull())
    files = bad.select(F.input_file_name().alias("file"))
    return files.distinct() if lines else files


def stations_of_resources(
    landed: DataFrame, chosen: DataFrame, catalogue: DataFrame, name: str = "Station", few: int = FEW_NAMES
) -> DataFrame:
    """Rows of the chosen resources whose station the catalogue lists for their basin.

    Names are compared as the catalogue gives them to the source. Resources of a basin
    without stations are read unfiltered. Up to ``few`` (basin, name) pairs become literals,
    which reach the scan; more are a semi join, for which Spark builds a Bloom filter at the
    scan where that pays (``spark.sql.optimizer.runtime.bloomFilter``).
    """
    asked = resource_stations(chosen.select(*KEYS).distinct(), catalogue).select(
        F.lower("basin").alias("_basin"), F.col("source_station_name").alias("_name")
    ).distinct()
    pairs = asked.limit(few + 1).collect()
    basin = F.lower("basin")
    if len(pairs) <= few:
        names: dict[str, set[str]] = {}
        for row in pairs:
            names.setdefault(row["_basin"], set()).add(row["_name"])
        if not names:
            return landed.limit(0)
        within = [
            (basin == b) if None in some else (basin == b) & F.col(name).isin(sorted(some)) for b, some in sorted(names.items())
        ]
        kept = landed.filter(reduce(Column.__or__, within))
        if any(None in some for some in names.values()):
            return kept
        # every row kept has one of all names: this part needs no partition column
        return kept.filter(F.col(name).isin(sorted(set().union(*names.values()))))
    named = asked.filter(F.length("_name") > 0)
    rows = landed.join(named, (basin == F.col("_basin")) & (F.col(name) == F.col("_name")), "left_semi")
    whole = asked.filter(F.col("_name").isNull()).select("_basin")
    return rows.unionByName(landed.join(whole, basin == F.col("_basin"), "left_semi"))
