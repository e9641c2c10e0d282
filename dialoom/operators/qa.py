"""Judging a generated data set and reporting on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from dialoom.config import ASSISTANT_VOICE, DURATION_TOLERANCE, EXPECTED_COUNTS, MIN_PLAUSIBLE_SECONDS, PERCENTILES, SPLITS, GenerationConfig
from dialoom.functions.stats import percentiles
from dialoom.operators.assignment import pool_of, user_voice
from dialoom.operators.incremental import latest, signal_reasons
from dialoom.operators.validation import alignment_reasons, quoted, reasons

WORDS = {"rate": "sample_rate ", "channels": "channels ", "empty": "wav has zero frames", "finite": "non-finite audio samples", "clips": "clipping detected"}
CHECKS = "split string, id string, ok boolean, problems array<string>, duration_seconds double, rms_left double, rms_right double, peak_left double, peak_right double, alignment_confidence_mean double, flagged_low_confidence boolean, user_voice string, category string"


def source_index(records: DataFrame) -> DataFrame:
    """(id, source_split, ...): one record an id, the last split's last line."""
    rank = F.coalesce(*[F.when(F.col("split") == s, F.lit(k)) for k, s in enumerate(SPLITS)], F.lit(len(SPLITS)))
    return latest(records, "id", F.struct(rank, F.col("line_no"))).withColumnRenamed("split", "source_split")


def voice_reasons(split: Column, id_: Column, voice: Column, seed: Column) -> Column:
    """Whether a voice is of the split's pool, and then whether it's the one that the seed gives."""
    known = F.coalesce(F.array_contains(pool_of(split), voice), F.lit(False))
    wanted = user_voice(id_, split, F.coalesce(seed, F.lit(0)))
    outside = F.concat(F.lit("user_voice "), quoted(voice), F.lit(" is not in the "), quoted(split), F.lit(" pool"))
    other = F.concat(F.lit("user_voice "), quoted(voice), F.lit(" does not match deterministic assignment "), quoted(wanted))
    return reasons((~known, outside), (known & (wanted != voice), other))


def check(wavs: DataFrame, companions: DataFrame, index: DataFrame, manifest: DataFrame, config: GenerationConfig) -> DataFrame:
    """One row for each sound file: ok, problems and figures (``CHECKS``).

    ``wavs(split, id, sample_rate, channels, n_frames, finite, speech_left, speech_right,
    clips, rms_left, rms_right, peak_left, peak_right, error)``;
    ``companions(split, id, parsed, alignments, confidence_mean, flagged, assistant_voice, user_voice,
    seed, category, source_checksum)``; ``index`` from ``source_index`` with source_checksum;
    ``manifest(split, id, duration)``, the last line of an id counting. An id of an
    earlier split is a problem by itself and isn't judged further.
    """
    rank = F.coalesce(*[F.when(F.col("split") == s, F.lit(k)) for k, s in enumerate(SPLITS)], F.lit(len(SPLITS)))
    w = wavs.withColumn("early", F.min_by("split", rank).over(Window.partitionBy("id")))
    c = companions.withColumn("has_json", F.lit(True))
    s = index.select("id", "source_split", F.col("category").alias("source_category"), F.col("source_checksum").alias("want_checksum"))
    m = manifest.select("split", "id", F.col("duration").alias("listed"), F.lit(True).alias("has_line"))
    j = w.join(c, ["split", "id"], "left").join(s, "id", "left").join(m, ["split", "id"], "left")
    seconds = F.when(F.col("sample_rate") > 0, F.col("n_frames") / F.col("sample_rate")).otherwise(F.lit(0.0))
    signal = signal_reasons({k: F.col(k) for k in ("sample_rate", "channels", "n_frames", "finite", "speech_left", "speech_right", "clips")}, config, WORDS)
    short = reasons((seconds < MIN_PLAUSIBLE_SECONDS, F.format_string("implausibly short duration %.3fs", seconds)))
    aligned = F.when(F.col("alignments").isNull() | (F.size("alignments") == 0), F.array(F.lit("alignments missing or empty"))).otherwise(alignment_reasons(F.col("alignments"), seconds))
    assistant = reasons((~F.col("assistant_voice").eqNullSafe(F.lit(ASSISTANT_VOICE)), F.concat(F.lit("assistant_voice "), quoted(F.col("assistant_voice")), F.lit(f" != required '{ASSISTANT_VOICE}'"))))
    user = voice_reasons(F.col("split"), F.col("id"), F.col("user_voice"), F.col("seed"))
    unknown = F.col("source_split").isNull()
    source = reasons(
        (unknown, "dialogue id not found in source split files"),
        (~unknown & (F.col("source_split") != F.col("split")), F.concat(F.lit("source split "), quoted(F.col("source_split")), F.lit(" != output split "), quoted(F.col("split")), F.lit(" (split overlap/mismatch)"))),
        (~unknown & ~F.col("source_category").eqNullSafe(F.col("category")), "category mismatch between source and companion json"),
        (~unknown & ~F.col("want_checksum").eqNullSafe(F.col("source_checksum")), "source_dialogue checksum mismatch between source data and companion json"),
    )
    listed = reasons(
        (F.col("has_line").isNull(), "no corresponding entry in split manifest"),
        (F.col("has_line") & (F.abs(F.coalesce("listed", F.lit(-1.0)) - seconds) > DURATION_TOLERANCE), F.format_string("manifest duration %s does not match wav duration %.3f", F.col("listed").cast("string"), seconds)),
    )
    sound = F.concat(signal, short)
    why = (
        F.when(F.col("early") != F.col("split"), F.array(F.concat(F.lit("duplicate id across splits: also in "), F.col("early"))))
        .when(F.col("has_json").isNull(), F.array(F.lit("companion json missing")))
        .when(F.col("error").isNotNull(), F.array(F.concat(F.lit("wav failed to open: "), F.col("error"))))
        .when(~F.col("parsed"), F.concat(sound, F.array(F.lit("companion json failed to parse"))))
        .otherwise(F.concat(sound, aligned, assistant, user, source, listed))
    )
    j = j.withColumn("problems", why).withColumn("duration_seconds", F.when(F.col("error").isNull() & F.col("has_json"), seconds))
    return j.select(
        "split", "id", (F.size("problems") == 0).alias("ok"), "problems", "duration_seconds", "rms_left", "rms_right", "peak_left", "peak_right",
        F.col("confidence_mean").alias("alignment_confidence_mean"), F.col("flagged").alias("flagged_low_confidence"), "user_voice", "category",
    )


# ---- reports over checks -------------------------------------------------------


def split_summary(checks: DataFrame) -> DataFrame:
    """(split, found, valid, invalid, hours, p0 ... p100): hours and percentiles over valid rows alone."""
    seconds = F.when(F.col("ok"), F.col("duration_seconds"))
    p = percentiles(seconds)
    g = checks.groupBy("split").agg(F.count("*").alias("found"), F.count_if("ok").alias("valid"), F.round(F.coalesce(F.sum(seconds), F.lit(0.0)) / 3600, 6).alias("hours"), *[c.alias(k) for k, c in p.items()])
    return g.select("split", "found", "valid", (F.col("found") - F.col("valid")).alias("invalid"), "hours", *p)


def category_hours(checks: DataFrame) -> DataFrame:
    name = F.coalesce(F.nullif(F.col("category"), F.lit("")), F.lit("unknown"))
    return checks.where("ok").groupBy(name.alias("category")).agg(F.round(F.sum("duration_seconds") / 3600, 6).alias("hours"))


def voice_distribution(checks: DataFrame) -> DataFrame:
    return checks.where("ok AND user_voice <> ''").groupBy("split", "user_voice").agg(F.count("*").alias("n"))


def figures(checks: DataFrame, columns: tuple[str, ...] = ("rms_left", "rms_right", "peak_left", "peak_right", "alignment_confidence_mean")) -> DataFrame:
    """(figure, p0 ... p100) over all rows that have it, valid or not."""
    out = None
    for c in columns:
        p = percentiles(F.col(c).cast("double"))
        one = checks.agg(*[v.alias(k) for k, v in p.items()]).select(F.lit(c).alias("figure"), *p)
        out = one if out is None else out.unionByName(one)
    return out


def completion(valid: DataFrame, index: DataFrame) -> DataFrame:
    """One row: how many percent of the index is valid; null for an empty index."""
    n = index.agg(F.count("*").alias("n_index"))
    return valid.agg(F.count("*").alias("n_valid")).join(F.broadcast(n)).select("n_valid", "n_index", F.round(F.try_divide(F.col("n_valid") * 100.0, F.col("n_index")), 4).alias("completion_percent"))


def voice_leaks(checks: DataFrame, pool: DataFrame) -> DataFrame:
    """(split, voice, problem): voices used outside their pool, and pool voices that nobody uses."""
    used = checks.where("user_voice IS NOT NULL").select("split", F.col("user_voice").alias("voice")).distinct()
    p = pool.select("split", "voice")
    leaked = used.join(F.broadcast(p), ["split", "voice"], "left_anti").withColumn("problem", F.lit("leaked"))
    return leaked.unionByName(p.join(used, ["split", "voice"], "left_anti").withColumn("problem", F.lit("missing")))


def verdict(checks: DataFrame, spark: SparkSession, expected: dict[str, int] = EXPECTED_COUNTS) -> DataFrame:
    """(split, found, valid, expected, verdict): incomplete, then invalid, else complete."""
    want = spark.createDataFrame(list(expected.items()), "split string, expected long")
    have = checks.groupBy("split").agg(F.count("*").alias("found"), F.count_if("ok").alias("valid"))
    j = want.join(F.broadcast(have), "split", "left").select("split", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("valid", F.lit(0)).alias("valid"), "expected")
    said = F.when(F.col("found") < F.col("expected"), "incomplete").when(F.col("valid") < F.col("found"), "invalid").otherwise("complete")
    return j.withColumn("verdict", said)


def report(checks: DataFrame, index: DataFrame, partial_files: list[str]) -> dict:
    """All summaries as one small dict: three splits, six categories, a few dozen voices."""
    invalid = checks.where("NOT ok").select("split", "id", "problems")
    n_invalid = invalid.count()
    return {
        "splits": [r.asDict() for r in split_summary(checks).orderBy("split").collect()],
        "category_hours": {r.category: r.hours for r in category_hours(checks).collect()},
        "voices": [r.asDict() for r in voice_distribution(checks).orderBy("split", "user_voice").collect()],
        "figures": [r.asDict() for r in figures(checks).collect()],
        **completion(checks.where("ok"), index).first().asDict(),
        "n_flagged_low_confidence": checks.where("flagged_low_confidence").count(),
        "n_invalid": n_invalid,
        "invalid": [r.asDict() for r in invalid.orderBy("split", "id").limit(200).collect()],  # shown, not all
        "partial_files": partial_files,
        "ok": n_invalid == 0 and not partial_files,
    }


def names() -> tuple[str, ...]:
    return tuple(f"p{p}" for p in PERCENTILES)
