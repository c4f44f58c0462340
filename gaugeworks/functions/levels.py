"""Level thresholds: status, alert flag, plausible band, display attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gaugeworks.schema import (
    BUFFER_OPACITY,
    BUFFER_RADIUS,
    DANGER,
    EXCEEDED,
    FLOOD_ALERT_MM,
    NORMAL,
    STATUS_COLOURS,
    UNKNOWN_COLOUR,
    WARNING,
)


def flood_status(level: Column, warning: Column, danger: Column, high: Column) -> Column:
    """First matching category; a comparison with a missing side never holds."""
    return (
        F.when(level < warning, NORMAL)
        .when((level >= warning) & (level < danger), WARNING)
        .when((level >= danger) & (level < high), DANGER)
        .when(level >= high, EXCEEDED)
    )


def flood_alert(level_mm: Column, threshold: float = FLOOD_ALERT_MM) -> Column:
    """Above the threshold; a missing level is no alert."""
    return F.coalesce(level_mm > threshold, F.lit(False))


def level_band(warning: Column, danger: Column, high: Column) -> tuple[Column, Column]:
    """Half the lowest and 1.6 times the highest usable threshold."""
    usable = F.filter(F.array(warning, danger, high), lambda x: (x > 0) & (x < float("inf")))
    return 0.5 * F.array_min(usable), 1.6 * F.array_max(usable)


def clip_to_band(level: Column, low: Column, high: Column) -> Column:
    """Pull a level to the nearer band end; no band, no change (P20)."""
    return F.when(level < low, low).when(level > high, high).otherwise(level)


def status_colour(status: Column) -> Column:
    """Display colour of a status, grey when unknown."""
    key = F.upper(F.trim(status))
    colour = None
    for name, value in STATUS_COLOURS.items():
        colour = F.when(key == name, value) if colour is None else colour.when(key == name, value)
    return colour.otherwise(UNKNOWN_COLOUR)


def buffer_radius(risk: Column) -> Column:
    return BUFFER_RADIUS[0] + BUFFER_RADIUS[1] * risk


def buffer_opacity(risk: Column) -> Column:
    return BUFFER_OPACITY[0] + BUFFER_OPACITY[1] * (risk / 100.0)
