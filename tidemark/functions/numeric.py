"""Guarded arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """``100 * part / whole`` rounded half-up in decimals; null when ``whole`` is 0."""
    return F.round(
        F.lit(100).cast("decimal(3,0)") * part.cast("decimal(18,0)")
        / F.nullif(whole.cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)")),
        places,
    )


def ratio(part: Column, whole: Column, empty: float | None = None) -> Column:
    """``part / whole`` as double; ``empty`` (default null) when ``whole`` is 0."""
    guarded = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return guarded if empty is None else F.coalesce(guarded, F.lit(empty))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))
