"""Exact percentiles and guarded averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dialoom.config import PERCENTILES


def percentiles(value: Column, at: tuple[float, ...] = PERCENTILES, digits: int = 4) -> dict[str, Column]:
    """Named aggregates p0, p25, ...: linear between ranks, rounded; NaN where there is no value."""
    whole = F.percentile(value, F.array(*[F.lit(p / 100) for p in at]))
    return {f"p{p}": F.round(F.coalesce(F.get(whole, i), F.lit(float("nan"))), digits) for i, p in enumerate(at)}


def word_confidence(scores: Column) -> Column:
    """Geometric mean of frame scores held within [1e-6, 1], as an aggregate."""
    return F.exp(F.avg(F.ln(F.least(F.greatest(scores, F.lit(1e-6)), F.lit(1.0)))))
