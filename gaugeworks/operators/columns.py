"""Column-level operators: alias matching, renames, ordering, type inference."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Observation, functions as F

from gaugeworks.functions import parsing
from gaugeworks.schema import (
    DAILY_COLUMNS,
    FIELD_ALIASES,
    FRENCH_CATEGORIES,
    PROVIDER_TO_ENGLISH,
    READING_COLUMNS,
)


def named(name: str) -> Column:
    """A top-level column whose name may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_columns(df: DataFrame, aliases: dict[str, list[str]] = FIELD_ALIASES) -> DataFrame:
    """Provider spellings to standard names.

    Several spellings of one standard column are coalesced in input order;
    columns that match nothing are kept.
    """
    standard_of = {alias: standard for standard, names in aliases.items() for alias in names}
    matches: dict[str, list[str]] = {}
    extras = []
    for name in df.columns:
        standard = standard_of.get(name.strip().lower())
        if standard is None:
            extras.append(name)
        else:
            matches.setdefault(standard, []).append(name)
    types = dict(df.dtypes)

    def merged(names: list[str]) -> Column:
        if len({types[n] for n in names}) == 1:
            return F.coalesce(*[named(n) for n in names])
        return F.coalesce(*[named(n).cast("string") for n in names])

    return df.select(
        *[merged(names).alias(standard) for standard, names in matches.items()],
        *[named(n) for n in extras if n not in matches],
    )


def order_columns(df: DataFrame, order: list[str] = READING_COLUMNS) -> DataFrame:
    """Preferred order first, unknown columns after it."""
    known = [c for c in order if c in df.columns]
    return df.select(*known, *[named(c) for c in df.columns if c not in known])


def canonical(df: DataFrame, order: list[str] = READING_COLUMNS) -> DataFrame:
    """Only schema columns, in schema order (P5)."""
    return df.select(*[c for c in order if c in df.columns])


def with_utc_timestamp(df: DataFrame, source_zone: str = "UTC", column: str = "timestamp") -> DataFrame:
    dtype = dict(df.dtypes).get(column)
    parsed = F.lit(None).cast("timestamp") if dtype is None else parsing.parse_utc(F.col(column), source_zone, dtype)
    return df.withColumn(column, parsed)


def drop_untimed(df: DataFrame, column: str = "timestamp", report: Observation | None = None) -> DataFrame:
    """Rows without a timestamp go (P7), counted as ``dropped_rows`` if a report is asked for."""
    if report is not None:
        df = df.observe(report, F.count_if(F.col(column).isNull()).alias("dropped_rows"))
    return df.filter(F.col(column).isNotNull())


def coerce_doubles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers or NULL; an absent column becomes an all-NULL one."""
    types = dict(df.dtypes)
    return df.withColumns(
        {
            c: parsing.to_double(F.col(c), types[c]) if c in types else F.lit(None).cast("double")
            for c in columns
        }
    )


def to_english(df: DataFrame) -> DataFrame:
    """Provider names to English, unless the English column exists."""
    present = set(df.columns)
    return df.withColumnsRenamed(
        {src: dst for src, dst in PROVIDER_TO_ENGLISH.items() if src in present and dst not in present}
    )


def to_provider(df: DataFrame) -> DataFrame:
    """English names back to the provider's."""
    return df.withColumnsRenamed({dst: src for src, dst in PROVIDER_TO_ENGLISH.items()})


def translate_categories(df: DataFrame, mappings: dict[str, dict[str, str]] = FRENCH_CATEGORIES) -> DataFrame:
    """Known category values translated, others kept."""
    translated = {}
    for column, mapping in mappings.items():
        if column in df.columns and mapping:
            entries = [F.lit(x) for pair in mapping.items() for x in pair]
            translated[column] = F.coalesce(F.element_at(F.create_map(*entries), F.col(column)), F.col(column))
    return df.withColumns(translated) if translated else df


def infer_text_types(df: DataFrame) -> dict[str, str]:
    """``date``, ``double`` or ``string`` for each text column (P10).

    One aggregate over all rows decides every column; only its single row
    reaches the driver.
    """
    texts = [name for name, dtype in df.dtypes if dtype == "string"]
    if not texts:
        return {}
    checks = []
    for i, name in enumerate(texts):
        c = named(name)
        checks += [
            F.bool_and(F.when(c.isNotNull(), parsing.to_day(c).isNotNull())).alias(f"day{i}"),
            F.bool_and(F.when(c.isNotNull(), parsing.to_double(c).isNotNull())).alias(f"number{i}"),
        ]
    verdict = df.agg(*checks).first()
    return {
        name: "date" if verdict[f"day{i}"] else "double" if verdict[f"number{i}"] else "string"
        for i, name in enumerate(texts)
    }


def convert_types(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Text columns in their inferred (or given) types; bad values become NULL."""
    types = infer_text_types(df) if types is None else types
    held = dict(df.dtypes)
    convert = {"date": parsing.to_day, "double": parsing.to_double}
    changes = {
        name: convert[kind](named(name), held[name])
        for name, kind in types.items()
        if kind in convert and name in held
    }
    return df.withColumns(changes) if changes else df


def order_daily(df: DataFrame) -> DataFrame:
    return order_columns(df, DAILY_COLUMNS)
