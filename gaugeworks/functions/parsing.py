"""Text to typed values; whatever does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values: accepted shapes ----------------------------------------
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
OFFSET = r"\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})$"
DAY_FIRST = r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{2}$"
DATE_START = r"^\d{1,4}[-/]\d"
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}"
DAY_FIRST_DATE = r"^\d{1,2}-\d{1,2}-\d{4}"
DAY_FIRST_SLASH = r"^\d{1,2}/\d{1,2}/\d{4}"
YEAR_FIRST_SLASH = r"^\d{4}/\d{1,2}/\d{1,2}"
# ---------------------------------------------------------------------------


def finite(c: Column) -> Column:
    """NaN and infinities count as missing."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def to_double(c: Column, dtype: str = "string") -> Column:
    """Number or NULL (P8); the pattern keeps out ``1.0f`` and ``nan``."""
    if dtype != "string":
        return finite(c.cast("double"))
    text = F.trim(c)
    return F.when(text.rlike(NUMBER), finite(text.try_cast("double")))


def _iso(text: Column) -> Column:
    return text.try_cast("timestamp")


def parse_utc(c: Column, source_zone: str = "UTC", dtype: str = "string") -> Column:
    """UTC timestamp or NULL.

    Row by row: an explicit offset wins; otherwise day-first with dashes, ISO,
    day-first with slashes, year-first with slashes, each read in ``source_zone``. The session is UTC.
    """
    if dtype == "timestamp":
        return c
    if dtype in ("timestamp_ntz", "date"):
        return F.to_utc_timestamp(c.cast("timestamp"), source_zone)
    text = F.trim(c)

    def read(naive: Column) -> Column:
        return F.to_utc_timestamp(naive, source_zone)

    offset = _iso(F.regexp_replace(text, r"\s*([+-]\d{2}):?(\d{2})$", "$1:$2"))
    others = (
        F.when(text.rlike(ISO_DATE), F.when(text.rlike(OFFSET), offset).otherwise(read(_iso(text))))
        .when(text.rlike(DAY_FIRST_DATE), read(_day_first(text, "-")))
        .when(text.rlike(DAY_FIRST_SLASH), read(_day_first(text, "/")))
        .when(text.rlike(YEAR_FIRST_SLASH), read(_iso(F.regexp_replace(text, "/", "-"))))
    )
    # the provider's own shape first: most rows take one pattern and one parse,
    # and what cannot be a date takes two patterns and none
    day_first = read(F.try_to_timestamp(text, F.lit("d-M-yyyy H:mm")))
    return F.when(text.rlike(DAY_FIRST), day_first).otherwise(F.when(text.rlike(DATE_START), others))


def _day_first(text: Column, mark: str) -> Column:
    day = f"d{mark}M{mark}yyyy"
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(f"{day} H:mm")),
        F.try_to_timestamp(text, F.lit(f"{day} H:mm:ss")),
        F.try_to_timestamp(text, F.lit(day)),
    )


def to_day(c: Column, dtype: str = "string") -> Column:
    """Calendar day or NULL."""
    if dtype != "string":
        return c.cast("date")
    return parse_utc(c).cast("date")
