"""Array expressions over samples; for arrays that fit a row comfortably (a few ten thousand samples).

Longer signals belong in the Arrow functions of ``operators.generation``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dialoom.config import LIMITER_CEILING, SPEECH_FLOOR


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda evaluates what it holds for each element anew."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def peak(s: Column) -> Column:
    """Greatest absolute sample; 0 for an empty signal, NaN if it holds one."""
    return F.coalesce(F.array_max(F.transform(s, lambda x: F.abs(x.cast("double")))), F.lit(0.0))


def rms(s: Column) -> Column:
    power = F.aggregate(s, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.when(F.size(s) > 0, F.sqrt(power / F.size(s))).otherwise(F.lit(0.0))


def all_finite(s: Column) -> Column:
    return F.forall(s, lambda x: ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))


def clips(s: Column, threshold: float) -> Column:
    p = peak(s)
    return ~F.isnan(p) & (p >= threshold)  # Spark orders NaN above all numbers


def has_speech(s: Column, floor: float = SPEECH_FLOOR) -> Column:
    p = peak(s)
    return ~F.isnan(p) & (p > floor)


def limit(s: Column, ceiling: float = LIMITER_CEILING) -> Column:
    """Scale a signal that passes 1 so that its peak is the ceiling."""
    return bind(
        F.struct(s.alias("s"), peak(s).alias("p")),
        lambda b: bind(F.when(b["p"] > 1.0, F.lit(ceiling) / b["p"]).otherwise(F.lit(1.0)), lambda gain: F.transform(b["s"], lambda x: x.cast("double") * gain)),
    )


def fade(s: Column, rate: int, seconds: float) -> Column:
    """Straight ramps from 0 at either end, no longer than half the signal."""
    def shape(b: Column) -> Column:
        n, length = F.size(b["s"]), b["length"]
        up = lambda i: F.when(i < length, i / F.greatest(length - 1, F.lit(1))).otherwise(F.lit(1.0))
        return F.when(length <= 0, F.transform(b["s"], lambda x: x.cast("double"))).otherwise(F.transform(b["s"], lambda x, i: x.cast("double") * up(i) * up(n - 1 - i)))

    length = F.least(F.bround(F.lit(seconds * rate)).cast("int"), F.floor(F.size(s) / 2).cast("int"))
    return bind(F.struct(s.alias("s"), length.alias("length")), shape)


def join_chunks(chunks: Column, rate: int, pause_seconds: float) -> Column:
    """Chunks in order with silence between them."""
    gap = F.array_repeat(F.lit(0.0).cast("float"), round(rate * pause_seconds))
    return bind(chunks, lambda b: F.flatten(F.transform(b, lambda c, i: F.when(i < F.size(b) - 1, F.concat(c, gap)).otherwise(c))))


def pcm16(s: Column) -> Column:
    """16-bit samples: clipped to one, scaled by 32767, cut towards zero."""
    return F.transform(s, lambda x: (F.greatest(F.least(x.cast("double"), F.lit(1.0)), F.lit(-1.0)) * 32767).cast("int"))


def samples_of(seconds: Column, rate: int) -> Column:
    return F.bround(seconds * rate).cast("long")
