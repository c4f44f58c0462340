"""Text expressions: names, keys and display strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_name(c: Column) -> Column:
    """Trimmed, lower-case name with inner whitespace collapsed."""
    return F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))


def fixed(c: Column, digits: int) -> Column:
    """``%.<digits>f``: a plain pattern rounds half-even on the binary value as C does."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c, F.lit(pattern))


def reading_key(station: Column, ts: Column, level: Column) -> Column:
    """``code_yyyy-MM-ddTHH:mm:ss+0000_%.4f``; missing parts are empty."""
    empty = F.lit("")
    return F.concat_ws(
        "_",
        F.coalesce(station, empty),
        F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxx"), empty),
        F.coalesce(fixed(level, 4), empty),
    )


def daily_key(station: Column, day: Column, level: Column) -> Column:
    """``station_yyyy-MM-dd_value`` with the value read as a double."""
    empty = F.lit("")
    return F.concat_ws(
        "_",
        F.coalesce(station, empty),
        F.coalesce(F.date_format(day, "yyyy-MM-dd"), empty),
        F.coalesce(level.cast("double").cast("string"), empty),
    )


def station_label(name: Column, code: Column) -> Column:
    """``name (code)`` for catalogue stations, the bare code otherwise."""
    return F.coalesce(F.concat(name, F.lit(" ("), code, F.lit(")")), code)


def station_popup(
    code: Column, name: Column, basin: Column, level: Column, status: Column, risk: Column, ts: Column
) -> Column:
    """Plain-text station card."""
    absent = F.lit("n/a")
    return F.concat(
        F.coalesce(name, code),
        F.lit(" | Basin: "),
        F.coalesce(basin, absent),
        F.lit(" | Level: "),
        F.coalesce(fixed(level, 2), F.lit("nan")),
        F.lit(" m | Status: "),
        F.coalesce(status, F.lit("NORMAL")),
        F.lit(" | Risk (forecast): "),
        F.coalesce(F.concat(fixed(risk, 0), F.lit(" / 100")), absent),
        F.lit(" | Updated: "),
        F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), absent),
    )
