"""Checksums and draws that depend on values alone, never on row order or partitions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, functions as F


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def ascii_json(value: Column) -> Column:
    """JSON of a struct with what lies beyond ASCII escaped; struct fields must be in alphabetical order.

    Characters beyond the basic plane become surrogate pairs.
    """
    def escape(c: Column) -> Column:
        n = F.ascii(c)
        hex4 = lambda x: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(x)), 4, "0"))
        pair = F.concat(hex4(F.shiftright(n - 0x10000, 10) + 0xD800), hex4((n - 0x10000).bitwiseAND(0x3FF) + 0xDC00))
        return F.when(n > 0xFFFF, pair).when(n > 126, hex4(n)).otherwise(c)

    text = F.to_json(value)
    # Most texts are ASCII: only others are taken apart.
    return F.when(text.rlike(r"^[\x00-\x7E]*$"), text).otherwise(F.array_join(F.transform(F.split(text, ""), escape), ""))


def dialogue_checksum(category: Column, id_: Column, turns: Column) -> Column:
    """Over category, id and the turns' speakers and texts; other fields don't count."""
    said = F.transform(turns, lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    return sha256(ascii_json(F.struct(category.alias("category"), id_.alias("id"), said.alias("turns"))))


def config_checksum(settings: dict, split: str, voice: str) -> str:
    """On the driver: there is one for each split and voice, not for each row."""
    text = json.dumps({"config": settings, "split": split, "user_voice": voice}, sort_keys=True, separators=(",", ":"))
    return hashlib.sha256(text.encode()).hexdigest()


def seed_int(*parts: Column | str | int) -> Column:
    """The first 64 bits of a hash of the parts, unsigned, as decimal(20,0)."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def uniform(seed: Column, low: float, high: float) -> Column:
    """A double in [low, high) from the 53 highest bits of a seed."""
    return F.lit(low) + F.floor(seed / 2048).cast("double") / F.lit(float(1 << 53)) * (F.lit(high) - F.lit(low))


def pick(seed: Column, pool: Column) -> Column:
    """An element of an array; null for a null or empty one."""
    return F.when(F.size(pool) > 0, F.get(pool, (seed % F.size(pool)).cast("int")))
