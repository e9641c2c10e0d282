"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from dialoom.llm.common import WORD, stored

#: Sources up to this many are broadcast with their rates (a few dozen bytes each); more are joined by a shuffle.
BROADCAST_SOURCES = 20_000
BUCKETS = 4096
#: Files for tables of one row a source.
FEW = 8


def targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """``sources(source, source_size)`` with ``target``.

    Sources are ranked by code point, null last, and take the weights in turn.
    They share the total by weight; a source stops at ``most`` times its own size
    and what it leaves is shared by weight among the others, until none is above.
    """
    # Ranks without one task for all sources: dealt by range, ranked within, offset by the counts before.
    placed = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("pid", F.spark_partition_id()), "sources")
    before = placed.groupBy("pid").agg(F.count("*").alias("n")).collect()  # one row a partition
    offsets, at = {}, 0
    for pid, n in sorted((r.pid, r.n) for r in before):
        offsets[pid], at = at, at + n
    # The number of partitions bounds this literal.
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in offsets.items() for x in kv]), F.col("pid")) if offsets else F.lit(0)
    rank = F.row_number().over(Window.partitionBy("pid").orderBy(F.col("source").asc_nulls_last())) - 1 + offset
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(placed.select("source", "source_size", weight.alias("weight")), "sources", FEW)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("weight") * level > most * F.col("source_size")
        s = ranked.agg(F.sum(F.when(over, most * F.col("source_size")).otherwise(0.0)).alias("c"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w"), F.count_if(over).alias("k")).first()
        if s.k == capped or not s.w:
            break
        capped, level = s.k, (total - s.c) / s.w
    level = 0.0 if level is None else level
    return ranked.withColumn("target", F.least(F.col("weight") * level, most * F.col("source_size")))


def balance(hist: DataFrame, goals: DataFrame, most: float, tolerance: float = 1e-7, rounds: int = 60) -> DataFrame:
    """Solve the dual for each source: ``(source, mean, lam)``.

    Over documents the rates nearest (in relative entropy) to one copy each that meet
    sum(rate * size) = target with rate <= ``most`` are min(most, exp(lam * size / mean)).
    ``hist(source, size, n)`` stands for the documents. Each Newton round is one
    map-side combined sum of the value and the slope by source; a bracket kept
    beside it halves the step where the cap makes the dual bend.
    """
    stats = hist.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean"))
    state = stored(
        goals.join(stats, goals.source.eqNullSafe(stats.source)).select(goals.source, "mean", "target", "source_size", F.when(F.col("source_size") > 0, F.log(F.least(F.col("target") / F.col("source_size"), F.lit(most)))).otherwise(0.0).alias("lam"), F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"), ((F.col("source_size") == 0) | (F.col("target") >= most * F.col("source_size") * (1 - 1e-12))).alias("done")),
        "dual", FEW,
    )
    for _ in range(rounds):
        x = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
        tokens = F.col("n") * F.col("size")
        s = state.where("not done").alias("s")
        sums = hist.alias("h").join(s, F.col("h.source").eqNullSafe(F.col("s.source"))).groupBy(F.col("s.source").alias("src")).agg(F.sum(tokens * F.least(rate, F.lit(most))).alias("f"), F.sum(F.when(rate < most, tokens * x * rate).otherwise(0.0)).alias("g"))
        j = state.join(sums, state.source.eqNullSafe(sums.src), "left")
        gap = F.col("f") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        # Newton on the logarithm of the sum, which is nearly straight: a handful of rounds.
        newton = F.col("lam") + (F.log("target") - F.log("f")) * F.try_divide("f", "g")
        middle = F.when((lo > -1e9) & (hi < 1e9), (lo + hi) / 2).when(gap > 0, F.col("lam") - 1 - F.abs(F.col("lam"))).otherwise(F.col("lam") + 1 + F.abs(F.col("lam")))
        step = F.when((F.col("g") > 0) & (newton > lo) & (newton < hi), newton).otherwise(middle)
        met = F.abs(gap) <= tolerance * F.col("target")
        done = F.col("done") | F.coalesce(met, F.lit(True)) | ((hi - lo) < 1e-12)
        state = stored(j.select("source", "mean", "target", "source_size", F.when(done, F.col("lam")).otherwise(step).alias("lam"), F.coalesce(lo, F.col("lo")).alias("lo"), F.coalesce(hi, F.col("hi")).alias("hi"), done.alias("done")), "dual", FEW)
        if state.where("not done").isEmpty():
            break
    # Sums of doubles may differ in the last bits between runs; nine digits don't.
    return state.select("source", "mean", "target", "source_size", F.round("lam", 9).alias("lam"))


def numbered(rows: DataFrame, most: int = 100_000) -> DataFrame:
    """``tie`` made different for rows that share it: by their number in the order of all columns.

    Only shared ones are looked at again. One that more than ``most`` rows share is numbered in as many parts.
    """
    shared = stored(rows.groupBy("tie").agg(F.count("*").alias("rows_alike")).where("rows_alike > 1"), "alike")
    if shared.isEmpty():
        return rows
    alike = rows.join(shared, "tie")
    part = F.pmod(F.monotonically_increasing_id(), F.ceil(F.col("rows_alike") / most))
    n = F.row_number().over(Window.partitionBy("tie", "part").orderBy(*[c for c in rows.columns if c != "tie"]))
    alike = alike.withColumn("part", part).withColumn("tie", F.when((n == 1) & (F.col("part") == 0), F.col("tie")).otherwise(F.xxhash64("tie", "part", n)))
    return rows.join(shared, "tie", "left_anti").select(rows.columns).unionByName(alike.select(rows.columns))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """How often each document is taken: doc_id, source, size, source_size, target, rate, copies, taken.

    ``size`` is the number of words (null text: 0). Rates come from entropy
    balancing by source; a hash of id, text and, among rows alike in both, the row's number rounds them, and a shift
    of the rounding threshold by source, found on a histogram, brings the whole words taken to the
    target. A null source is a source of its own, ranked last; an empty table gives an empty one. ``keep``
    names further columns to carry.
    """
    sized = docs.select("doc_id", *keep, F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("doc_id", "text").alias("tie"))
    sized = numbered(sized)
    hist = stored(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    goals = stored(targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most), "goals", FEW)
    lam = balance(hist, goals, float(most))
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    one = lam.select(F.col("source").alias("src"), "mean", "target", "source_size", "lam", full.alias("full"))
    small = one.count() <= BROADCAST_SOURCES
    hint = (lambda d: F.broadcast(d)) if small else (lambda d: d)

    def rated(d: DataFrame) -> DataFrame:
        rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.round(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))), 9)))
        rate = F.when(F.col("mean") > 0, rate).otherwise(F.lit(1.0))
        unit = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "tie"), 11) / F.lit(float(1 << 53))
        d = d.join(hint(one), d.source.eqNullSafe(F.col("src"))).withColumn("rate", rate)
        # A document gets its extra copy while this is below the source's shift.
        return d.withColumn("late", unit - (F.col("rate") - F.floor("rate"))).withColumn("bucket", F.floor((F.col("late") + 1) / 2 * BUCKETS).cast("int"))

    spare = F.col("rate") > F.floor("rate")
    by = rated(sized).groupBy("source", "bucket").agg(F.sum(F.when(spare, F.col("size")).otherwise(0)).alias("tokens"), F.sum(F.floor("rate") * F.col("size")).alias("sure"))
    w = Window.partitionBy("source").orderBy("bucket")  # at most BUCKETS rows a source
    run = by.withColumn("taken", F.sum("tokens").over(w)).withColumn("sure", F.sum("sure").over(Window.partitionBy("source")))
    run = run.join(hint(one.select("src", "target")), run.source.eqNullSafe(F.col("src")))
    off = F.abs(F.col("sure") + F.col("taken") - F.col("target"))
    none = F.abs(F.col("sure") - F.col("target"))
    cut = run.groupBy("source").agg(F.min_by("bucket", F.struct(off, "bucket")).alias("cut"), F.min(off).alias("off"), F.min(none).alias("none"))
    cut = stored(cut.select(F.col("source").alias("cs"), F.when(F.col("none") < F.col("off"), F.lit(-1)).otherwise(F.col("cut")).alias("cut")), "cuts", FEW)
    out = rated(sized).join(hint(cut), F.col("source").eqNullSafe(F.col("cs")))
    copies = (F.floor("rate") + F.when(spare & (F.col("bucket") <= F.col("cut")), 1).otherwise(0)).cast("long")
    return out.select("doc_id", *keep, "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
