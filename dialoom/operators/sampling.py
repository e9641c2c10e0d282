"""Stratified subsets that cover all voices and categories, and work shards."""

from __future__ import annotations

import functools
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from dialoom.config import SPLITS, VOICE_POOLS
from dialoom.operators.assignment import user_voice


def largest_remainder(weights: DataFrame, total: int, key: str, weight: str = "weight", order: Column | None = None) -> DataFrame:
    """Adds ``quota``: the share of ``total`` rounded down, and one more for the greatest remainders.

    For a table of groups. Ties go by ``order`` (the key by default).
    """
    whole = Window.partitionBy()  # one row a group: a few dozen rows
    share = F.try_divide(F.col(weight) * F.lit(float(total)), F.sum(weight).over(whole))
    d = weights.withColumn("share", F.coalesce(share, F.lit(0.0))).withColumn("quota", F.floor("share").cast("long"))
    by = Window.orderBy((F.col("share") - F.floor("share")).desc(), order if order is not None else F.col(key))
    d = d.withColumn("rank", F.row_number().over(by)).withColumn("left", F.lit(total) - F.sum("quota").over(whole))
    more = F.when((F.sum(weight).over(whole) > 0) & (F.col("rank") <= F.col("left")), 1).otherwise(0)
    return d.withColumn("quota", F.col("quota") + more).drop("share", "rank", "left")


def split_targets(sizes: dict[str, int], pools: dict[str, int], total: int) -> dict[str, int]:
    """How many of each split to take: vectors of three numbers, on the driver.

    Each split first gets one for each voice if the total has that many, and the rest goes by
    size. What is beyond a split's size fills the room of the others, the roomiest first.
    """
    names = [s for s in SPLITS if s in sizes]
    size, voices = np.array([sizes[s] for s in names]), np.array([pools.get(s, 0) for s in names])
    base = np.minimum(voices, size)
    base = base * int(base.sum() < total)
    want = base + apportioned(size, total - int(base.sum()))
    room = np.maximum(size - want, 0)
    over = int(np.maximum(want - size, 0).sum())
    roomiest = np.argsort(-room, kind="stable")
    before = np.cumsum(room[roomiest]) - room[roomiest]
    filled = np.zeros_like(room)
    filled[roomiest] = np.clip(over - before, 0, room[roomiest])
    return dict(zip(names, (np.minimum(want, size) + filled).tolist()))


def apportioned(weights: np.ndarray, total: int) -> np.ndarray:
    """Whole shares of ``total`` by weight, the greatest remainders rounded up; the array form of ``largest_remainder``."""
    if not weights.sum() or total <= 0:
        return np.zeros(len(weights), np.int64)
    share = weights / weights.sum() * total
    rank = np.argsort(np.argsort(np.floor(share) - share, kind="stable"), kind="stable")
    return np.floor(share).astype(np.int64) + (rank < total - np.floor(share).sum())


@dataclass(frozen=True)
class Subset:
    """What was selected and what it covers."""

    selected: DataFrame
    categories: DataFrame
    voices: DataFrame
    targets: dict[str, int]


def stratified(records: DataFrame, total: int = 50, seed: int = 0, pools: dict[str, tuple[str, ...]] = VOICE_POOLS) -> Subset:
    """A subset of ``records(split, id, category)`` of about ``total`` dialogues.

    First the smallest id of each voice, in the pools' order, as far as a split's
    target goes; then a dialogue of each category that is still missing, whose split may
    grow by one for it; then the smallest other ids. The second step sees one candidate for each
    category and split, a handful of rows on the driver.
    """
    spark = records.sparkSession
    d = records.select("split", "id", "category").withColumn("voice", user_voice(F.col("id"), F.col("split"), seed))
    sizes = {r.split: r.n for r in d.groupBy("split").agg(F.count("*").alias("n")).collect()}  # three rows
    targets = split_targets(sizes, {s: len(v) for s, v in pools.items()}, total)
    pool = spark.createDataFrame([(s, k, v) for s, vs in pools.items() if s in targets for k, v in enumerate(vs)], "split string, ord int, voice string")
    heads = d.groupBy("split", "voice").agg(F.min(F.struct("id", "category")).alias("m")).select("split", "voice", "m.id", "m.category")
    ranked = heads.join(F.broadcast(pool), ["split", "voice"]).withColumn("k", F.row_number().over(Window.partitionBy("split").orderBy("ord")))
    first = [r for r in ranked.collect() if r.k <= targets[r.split]]  # at most one row a voice
    chosen = {(r.split, r.id) for r in first}
    covered = {r.category for r in first}
    have = Counter(split for split, _ in chosen)
    # A candidate is ranked by whether its split must grow for it, then by the order of splits.
    missing = set()
    options = defaultdict(list)
    for c in d.groupBy("category", "split").agg(F.min("id").alias("id")).collect():  # at most one row a category and split
        options[c.category].append((SPLITS.index(c.split), c.split, c.id))
    for category in sorted(options.keys() - covered):
        ranked_ = [(have[split] >= targets[split], place, split, id_) for place, split, id_ in options[category] if have[split] < sizes[split]]
        if not ranked_:
            missing.add(category)
            continue
        *_, split, id_ = min(ranked_)
        chosen.add((split, id_))
        have[split] += 1
        covered.add(category)
    targets = {s: max(n, have[s]) for s, n in targets.items()}
    taken = spark.createDataFrame(sorted(chosen), "split string, id string")
    rest = d.join(F.broadcast(taken), ["split", "id"], "left_anti").select("split", "id")
    # The smallest ids of a split with a literal limit: each task keeps so many rows, nothing is sorted whole.
    fills = [rest.where(F.col("split") == s).orderBy("id").limit(n - have[s]) for s, n in targets.items() if n > have[s]]
    voices_seen = {(r.split, r.voice) for r in first}
    voices = spark.createDataFrame([(s, v, (s, v) in voices_seen) for s in targets for v in pools[s]], "split string, voice string, covered boolean")
    categories = spark.createDataFrame([(c, True) for c in sorted(covered)] + [(c, False) for c in sorted(missing)], "category string, covered boolean")
    return Subset(functools.reduce(DataFrame.unionByName, fills, taken), categories, voices, targets)


def shards(work: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Adds ``shard``: rows dealt in turn by their order. For work lists; plain parallelism needs ``repartition``."""
    return work.withColumn("shard", F.pmod(F.row_number().over(Window.orderBy(*order)) - 1, F.lit(n)).cast("int"))
