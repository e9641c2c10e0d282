"""Receipts, resumption, manifests and migrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from dialoom.config import GenerationConfig, VOICE_POOLS
from dialoom.functions import hashing
from dialoom.operators.assignment import user_voice
from dialoom.operators.validation import alignment_reasons, reasons

COMPLETED = (
    "id string, split string, category string, source_checksum string, config_checksum string, wav_checksum string, json_checksum string, duration_seconds double, "
    "alignment_confidence_mean double, flagged_low_confidence boolean, user_voice string, assistant_voice string"
)
FAILED = "id string, split string, reasons array<string>, timestamp double"


def latest(log: DataFrame, key: str | list[str], order: Column | str) -> DataFrame:
    """The last row of each key in an append log: a map-side combined maximum, not a sort of the log."""
    keys = [key] if isinstance(key, str) else key
    order = F.col(order) if isinstance(order, str) else order
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("last"))
    return last.select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])


def repair_ids(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Second and later rows of an id get ``__dup2``, ``__dup3``, ... in order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    fixed = F.when(n > 1, F.concat(F.col(key).cast("string"), F.lit("__dup"), n.cast("string"))).otherwise(F.col(key).cast("string"))
    return rows.withColumn("new_id", fixed)


def config_checksums(spark, config: GenerationConfig, pools: dict[str, tuple[str, ...]] = VOICE_POOLS) -> DataFrame:
    """(split, user_voice, config_checksum): one row a voice, computed on the driver."""
    rows = [(s, v, hashing.config_checksum(config.audio_dict(), s, v)) for s, vs in pools.items() for v in vs]
    return spark.createDataFrame(rows, "split string, user_voice string, config_checksum string")


def with_checksums(records: DataFrame, config: GenerationConfig) -> DataFrame:
    """Source records with their voice and the checksums a valid receipt must have."""
    d = records.withColumn("user_voice", user_voice(F.col("id"), F.col("split"), config.seed))
    d = d.withColumn("source_checksum", hashing.dialogue_checksum(F.col("category"), F.col("id"), F.col("turns")))
    return d.join(F.broadcast(config_checksums(records.sparkSession, config)), ["split", "user_voice"])


def receipt_reasons(source: Column, config: Column, receipt: Column, receipt_source: Column, receipt_config: Column) -> Column:
    """Why a receipt doesn't vouch for a record; ``receipt`` is null where there is none."""
    stale = reasons(
        (~receipt_source.eqNullSafe(source), "receipt source_checksum does not match current source record"),
        (~receipt_config.eqNullSafe(config), "receipt config_checksum does not match current generation config"),
    )
    return F.when(receipt.isNull(), F.array(F.lit("no completed receipt found"))).otherwise(stale)


def signal_reasons(d: dict[str, Column], config: GenerationConfig, words: dict[str, str]) -> Column:
    """Why decoded sound isn't usable. ``words``: the messages, which differ between resumption and reports."""
    has = d["n_frames"] > 0
    return reasons(
        (d["sample_rate"] != config.sample_rate, F.concat(F.lit(words["rate"]), d["sample_rate"].cast("string"), F.lit(f" != {config.sample_rate}"))),
        (d["channels"] != config.channels, F.concat(F.lit(words["channels"]), d["channels"].cast("string"), F.lit(f" != {config.channels}"))),
        (~has, words["empty"]),
        (has & ~d["finite"], words["finite"]),
        (has & ~d["speech_left"], "left (assistant) channel has no detectable speech"),
        (has & ~d["speech_right"], "right (user) channel has no detectable speech"),
        (has & d["clips"], words["clips"]),
    )


RESUME_WORDS = {"rate": "wav sample_rate ", "channels": "wav channels ", "empty": "wav has zero samples", "finite": "wav contains non-finite samples", "clips": "wav peak at/above clipping threshold"}


def verify(records: DataFrame, wavs: DataFrame, companions: DataFrame, receipts: DataFrame, config: GenerationConfig) -> DataFrame:
    """(split, id, ok, reasons) of finished work.

    ``wavs(split, id, sample_rate, channels, n_frames, finite, speech_left,
    speech_right, clips, error)``, ``companions(split, id, parsed, alignments)``,
    ``receipts``: a completed log with its latest rows. A missing or unreadable file is
    the one reason; a companion that isn't JSON hides what came before.
    """
    want = with_checksums(records, config).select("split", "id", F.col("source_checksum").alias("want_source"), F.col("config_checksum").alias("want_config"))
    w = wavs.withColumn("has_wav", F.lit(True))
    c = companions.withColumn("has_json", F.lit(True))
    r = receipts.select("id", F.col("source_checksum").alias("got_source"), F.col("config_checksum").alias("got_config"), F.lit(True).alias("has_receipt"))
    j = want.join(w, ["split", "id"], "left").join(c, ["split", "id"], "left").join(r, "id", "left")
    seconds = F.when(F.col("sample_rate") > 0, F.col("n_frames") / F.col("sample_rate")).otherwise(F.lit(0.0))
    signal = signal_reasons({k: F.col(k) for k in ("sample_rate", "channels", "n_frames", "finite", "speech_left", "speech_right", "clips")}, config, RESUME_WORDS)
    aligned = F.when(F.col("alignments").isNull() | (F.size("alignments") == 0), F.array(F.lit("alignments missing or empty"))).otherwise(alignment_reasons(F.col("alignments"), seconds))
    receipt = receipt_reasons(F.col("want_source"), F.col("want_config"), F.col("has_receipt"), F.col("got_source"), F.col("got_config"))
    why = (
        F.when(F.col("has_wav").isNull(), F.array(F.lit("wav missing")))
        .when(F.col("has_json").isNull(), F.array(F.lit("companion json missing")))
        .when(F.col("error").isNotNull(), F.array(F.concat(F.lit("wav failed to open: "), F.col("error"))))
        .when(~F.col("parsed"), F.array(F.lit("companion json failed to parse")))
        .otherwise(F.concat(signal, aligned, receipt))
    )
    return j.select("split", "id", why.alias("reasons")).select("split", "id", (F.size("reasons") == 0).alias("ok"), "reasons")


def worklist(records: DataFrame, verified: DataFrame) -> DataFrame:
    """Records without verified work. This comes before any expensive function in the plan."""
    return records.join(verified.where("ok").select("split", "id"), ["split", "id"], "left_anti")


def manifest(records: DataFrame, receipts: DataFrame) -> DataFrame:
    """(split, line_no, path, duration) of records with a completed receipt, old ones too."""
    r = receipts.select("id", "duration_seconds")
    path = F.concat(F.lit("audio/"), F.col("id"), F.lit(".wav"))
    return records.join(r, "id").select("split", "line_no", path.alias("path"), F.round("duration_seconds", 3).alias("duration"))


def migrate(receipts: DataFrame, checksums: DataFrame, keys: list[str], column: str = "config_checksum") -> tuple[DataFrame, DataFrame]:
    """Receipts with recomputed checksums, and one row with the number of changes (a dry run reads that alone)."""
    new = checksums.select(*keys, F.col(column).alias("_new"))
    j = receipts.join(F.broadcast(new), keys, "left").withColumn("_to", F.coalesce("_new", F.col(column)))
    changed = j.agg(F.count("*").alias("n_rows"), F.count_if(~F.col(column).eqNullSafe(F.col("_to"))).alias("n_changed"))
    return j.withColumn(column, F.col("_to")).select(*receipts.columns), changed


def generation_summary(records: DataFrame, receipts: DataFrame) -> DataFrame:
    """(split, total, completed, failed, hours)."""
    j = records.select("split", "id").join(receipts.select("id", "duration_seconds", F.lit(1).alias("done")), "id", "left")
    g = j.groupBy("split").agg(F.count("*").alias("total"), F.count("done").alias("completed"), (F.coalesce(F.sum("duration_seconds"), F.lit(0.0)) / 3600).alias("hours"))
    return g.select("split", "total", "completed", (F.col("total") - F.col("completed")).alias("failed"), F.round("hours", 6).alias("hours"))
