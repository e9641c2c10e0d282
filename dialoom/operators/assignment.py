"""Deterministic voices, speeds and pauses."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from dialoom.config import ASSISTANT_SPEED, ASSISTANT_VOICE, PAUSE_MAX, PAUSE_MIN, SPEED_MAX, SPEED_MIN, VOICE_POOLS
from dialoom.functions.hashing import pick, seed_int, uniform


def pool_of(split: Column, pools: dict[str, tuple[str, ...]] = VOICE_POOLS) -> Column:
    """The pool of a split as an array; an unknown split raises when it is evaluated."""
    out = F.when(F.lit(False), F.array().cast("array<string>"))
    for s, vs in pools.items():
        out = out.when(split == s, F.array(*map(F.lit, vs)))
    return out.otherwise(F.raise_error(F.concat(F.lit("no voice pool for split "), F.coalesce(split, F.lit("null")))).cast("array<string>"))


def user_voice(id_: Column, split: Column, seed: int = 0) -> Column:
    """A voice of the split's pool by a hash of seed, split and id."""
    return pick(seed_int(seed, "user_voice", split, id_), pool_of(split))


def user_speed(id_: Column, split: Column, turn: Column, seed: int = 0) -> Column:
    return uniform(seed_int(seed, "user_speed", split, id_, turn), SPEED_MIN, SPEED_MAX)


def pause_before(id_: Column, split: Column, turn: Column, seed: int = 0) -> Column:
    """0 before the first turn."""
    return F.when(turn <= 0, F.lit(0.0)).otherwise(uniform(seed_int(seed, "pause", split, id_, turn), PAUSE_MIN, PAUSE_MAX))


def voice_of_turn(speaker: Column, user: Column) -> Column:
    return F.when(speaker == "assistant", F.lit(ASSISTANT_VOICE)).otherwise(user)


def speed_of_turn(speaker: Column, user: Column) -> Column:
    return F.when(speaker == "assistant", F.lit(ASSISTANT_SPEED)).otherwise(user)


def language(voice: Column) -> Column:
    """The language code of a voice: the letter its name begins with; others raise."""
    first = F.substring(F.substring_index(voice, "_", 1), 1, 1)
    return F.when(first.isin("a", "b"), first).otherwise(F.raise_error(F.concat(F.lit("no language for voice "), F.coalesce(voice, F.lit("null")))).cast("string"))


def generator(*parts) -> np.random.Generator:
    """A numpy generator seeded by a hash of the parts, for results equal to numpy-based tools."""
    return np.random.default_rng(int.from_bytes(hashlib.sha256("|".join(map(str, parts)).encode()).digest()[:8], "big"))


def numpy_voice(seed: int = 0, pools: dict[str, tuple[str, ...]] = VOICE_POOLS):
    """A vectorised function (id, split) -> voice by numpy's generator; its draws aren't those of ``user_voice``."""

    @F.pandas_udf("string")
    def draw(ids: pd.Series, splits: pd.Series) -> pd.Series:
        return pd.Series([pools[s][int(generator(seed, i, "user_voice").integers(0, len(pools[s])))] for i, s in zip(ids, splits)], dtype=object)

    return draw


def numpy_uniform(purpose: str, low: float, high: float, seed: int = 0):
    """A vectorised function (id, turn) -> double in [low, high) by numpy's generator; purposes: user_speed, pause."""

    @F.pandas_udf("double")
    def draw(ids: pd.Series, turns: pd.Series) -> pd.Series:
        return pd.Series([0.0 if purpose == "pause" and t <= 0 else float(generator(seed, i, f"{purpose}:{t}").uniform(low, high)) for i, t in zip(ids, turns)], dtype=float)

    return draw
