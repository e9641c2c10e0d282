"""Command lines: generate, validate, repair ids, migrate checksums."""

from __future__ import annotations

import argparse
import functools
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from dialoom.config import SPLITS, GenerationConfig
from dialoom.functions import hashing, signal
from dialoom.operators import generation, incremental, qa, sampling, validation
from dialoom.session import build_session
from dialoom.sources import dialogues, sinks, wav


def measured(sound: DataFrame, config: GenerationConfig) -> DataFrame:
    """Decoded sound files as the figures that verification and reports read."""
    l, r = F.col("left"), F.col("right")
    return sound.select(
        F.regexp_extract("path", r"/([^/]+)/audio/[^/]+$", 1).alias("split"), F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("id"), "sample_rate", "channels", "n_frames",
        (signal.all_finite(l) & signal.all_finite(r)).alias("finite"), signal.has_speech(l).alias("speech_left"), signal.has_speech(r).alias("speech_right"),
        (signal.clips(l, config.clipping_peak_threshold) | signal.clips(r, config.clipping_peak_threshold)).alias("clips"),
        signal.rms(l).alias("rms_left"), signal.rms(r).alias("rms_right"), signal.peak(l).alias("peak_left"), signal.peak(r).alias("peak_right"), "error",
    )


COMPANION = (
    "split string, id string, category string, user_voice string, assistant_voice string, seed long, sample_rate int, channels int, duration_seconds double, source_checksum string, config_checksum string, "
    "alignments array<struct<word:string,start:double,end:double,speaker:string>>, confidence_mean double, confidence_min double, flagged boolean"
)


def companions(spark: SparkSession, root: str) -> DataFrame:
    """Companion records from the table beside the sound; ``parsed`` is false where a line isn't JSON of that shape."""
    path = f"{root}/companions"
    if not dialogues.exists(spark, path):
        return spark.createDataFrame([], COMPANION).withColumn("parsed", F.lit(True))
    raw = spark.read.schema("split string, id string, json string").parquet(path)
    d = raw.select("split", "id", F.from_json("json", COMPANION).alias("j"))
    return d.select("split", "id", *[F.col(f"j.{n}").alias(n) for n in _names()], F.col("j.source_checksum").isNotNull().alias("parsed"))


def _names() -> list[str]:
    return ["category", "user_voice", "assistant_voice", "seed", "duration_seconds", "source_checksum", "config_checksum", "alignments", "confidence_mean", "confidence_min", "flagged"]


def sound(spark: SparkSession, root: str, splits, config: GenerationConfig) -> DataFrame:
    out = None
    for s in splits:
        if any(n.endswith(".wav") and not n.startswith(".") for n in dialogues.children(spark, f"{root}/{s}/audio")):
            one = measured(wav.read(spark, f"{root}/{s}/audio"), config)
            out = one if out is None else out.unionByName(one)
    return out if out is not None else measured(spark.createDataFrame([], wav.DECODED), config)


def receipts(spark: SparkSession, root: str) -> DataFrame:
    log = dialogues.read_log(spark, f"{root}/receipts/completed", incremental.COMPLETED + ", seq double")
    return incremental.latest(log, "id", "seq")


def run_generation(spark: SparkSession, args: argparse.Namespace, synth=generation.stub_synth, align=generation.stub_align) -> int:
    config, splits = GenerationConfig(seed=args.seed), tuple(args.splits)
    partial = args.record_id or args.smoke_count
    tree = validation.check_tree(spark, args.source_root, splits, expected={} if partial else None)
    try:
        records = validation.require_valid(tree)
    except validation.SourceInvalid as e:
        print(e, file=sys.stderr)
        return 1
    if args.validate_only:
        return 0
    if args.record_id:
        records = records.where(F.col("id") == args.record_id).limit(1)
        if records.isEmpty():
            print(f"no record {args.record_id}", file=sys.stderr)
            return 1
    elif args.smoke_count:
        records = records.join(sampling.stratified(records, args.smoke_count, args.seed).selected, ["split", "id"], "left_semi")
    if args.dry_run:
        print(generation.dry_run(records).first().asDict())
        return 0
    root, began = args.output_root.rstrip("/"), time.time()
    for table in ("companions", "receipts/completed"):
        sinks.settle(spark, f"{root}/{table}")
    todo = records
    if args.resume:
        state = incremental.verify(records, sound(spark, root, splits, config), companions(spark, root).select("split", "id", "parsed", "alignments"), receipts(spark, root), config)
        todo = incremental.worklist(records, state)
    # The functions are expensive and the result is written in several forms: it is kept as a table, which
    # also parts it from the files that resumption read and that are replaced below.
    stage = f"{root}/staging-{uuid.uuid4().hex}"
    generation.generate(todo, config, synth, align).write.parquet(stage)
    made = spark.read.parquet(stage)
    good = made.where("reason IS NULL")
    wav.write(good, root, config.sample_rate)
    want = incremental.with_checksums(records, config).select("split", "id", "category", "user_voice", "source_checksum", "config_checksum")
    full = good.join(want, ["split", "id"]).withColumn("assistant_voice", F.lit(config.assistant_voice)).withColumn("seed", F.lit(config.seed).cast("long")).withColumn("sample_rate", F.lit(config.sample_rate)).withColumn("channels", F.lit(config.channels))
    new = sinks.companion(full.select("split", "id", *_names(), "sample_rate", "channels"))
    old_path = f"{root}/companions"
    if dialogues.exists(spark, old_path):
        new = spark.read.parquet(old_path).join(new.select("split", "id"), ["split", "id"], "left_anti").unionByName(new)
    sinks.replace(new, old_path)
    # Checksums of the files as they are, and of the companions' text, spaces and all.
    sums = [dialogues.hash_files(spark, f"{root}/{x}/audio/*.wav") for x in splits if dialogues.exists(spark, f"{root}/{x}/audio")]
    sums = functools.reduce(DataFrame.unionByName, sums, spark.createDataFrame([], "path string, sha256 string"))
    sums = sums.select(F.regexp_extract("path", r"/([^/]+)/audio/[^/]+$", 1).alias("split"), F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("id"), F.col("sha256").alias("wav_checksum"))
    texts = spark.read.parquet(old_path).select("split", "id", hashing.sha256(F.col("json")).alias("json_checksum"))
    vouched = full.join(sums, ["split", "id"], "left").join(texts, ["split", "id"], "left")
    done = vouched.select(
        "id", "split", "category", "source_checksum", "config_checksum", "wav_checksum", "json_checksum", "duration_seconds",
        F.col("confidence_mean").alias("alignment_confidence_mean"), F.col("flagged").alias("flagged_low_confidence"), "user_voice", "assistant_voice", F.lit(time.time()).alias("seq"),
    )
    sinks.append(done, f"{root}/receipts/completed")  # last: a receipt vouches for what is there
    failed = made.where("reason IS NOT NULL").select("id", "split", F.array("reason").alias("reasons"), F.lit(time.time()).alias("timestamp"))
    n_failed = failed.count()
    if n_failed:
        sinks.append(failed, f"{root}/receipts/failed")
    have = receipts(spark, root)
    sinks.write_manifests(incremental.manifest(records, have), root)
    summary = incremental.generation_summary(records, have).orderBy("split").collect()
    sinks.write_report(spark, f"{root}/generation_summary.json", {"by_split": {r.split: r.asDict() for r in summary}, "hours": sum(r.hours for r in summary), "dialogues": sum(r.total for r in summary), "seconds": time.time() - began})
    sinks.write_report(spark, f"{root}/provenance.json", dialogues.environment(spark) | {"config": config.as_dict()})
    sinks.remove(spark, stage)
    return 1 if n_failed else 0


def run_validation(spark: SparkSession, args: argparse.Namespace) -> int:
    config, root = GenerationConfig(), args.output_root.rstrip("/")
    splits = tuple(s for s in args.splits if dialogues.exists(spark, f"{root}/{s}"))
    tree = validation.check_tree(spark, args.source_root, splits, expected={})
    index = qa.source_index(tree.records)
    index = index.withColumn("source_checksum", hashing.dialogue_checksum(F.col("category"), F.col("id"), F.col("turns")))
    manifest = spark.createDataFrame([], "split string, id string, duration double")
    for s in splits:
        lines = dialogues.read_log(spark, f"{root}/{s}/manifest", "path string, duration double", placed=True)
        m = lines.select(F.lit(s).alias("split"), F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("id"), "duration", "at")
        m = incremental.latest(m, ["split", "id"], "at").select("split", "id", "duration")
        manifest = manifest.unionByName(m)
    c = companions(spark, root).drop("confidence_min", "config_checksum", "duration_seconds")
    checks = qa.check(sound(spark, root, splits, config), c, index, manifest, config).persist()
    report = qa.report(checks, index, [f"{s}/{n}" for s in splits for n in dialogues.leftovers(spark, root, s)])
    checks.unpersist()
    sinks.write_report(spark, f"{root}/qa_summary.json", report)
    return 0 if report["ok"] else 1


def run_repair(spark: SparkSession, args: argparse.Namespace) -> int:
    """Rename repeated ids into a sibling table; the source stays as it is."""
    lines = dialogues.read_lines(spark, args.source).withColumn("id", F.get_json_object("line", "$.id"))
    fixed = incremental.repair_ids(lines, "id", "line_no")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    field = F.regexp_extract("line", r'"id"\s*:\s*"[^"]*"', 0)
    renamed = F.replace("line", field, F.replace(field, quoted(F.col("id")), quoted(F.col("new_id"))))
    out = fixed.select("line_no", F.when((F.col("new_id") == F.col("id")) | F.col("id").isNull(), F.col("line")).otherwise(renamed).alias("value"))
    out.orderBy("line_no").select("value").coalesce(1).write.mode("overwrite").text(args.target)
    return 0


def run_migration(spark: SparkSession, args: argparse.Namespace) -> int:
    have = receipts(spark, args.output_root.rstrip("/"))
    new, counts = incremental.migrate(have, incremental.config_checksums(spark, GenerationConfig(seed=args.seed)), ["split", "user_voice"])
    print(counts.first().asDict())
    if not args.dry_run:
        sinks.replace(new.withColumn("seq", F.lit(time.time())), f"{args.output_root.rstrip('/')}/receipts/completed", "json")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="dialoom")
    sub = p.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--source-root", required=True)
    g.add_argument("--output-root", required=True)
    g.add_argument("--splits", nargs="+", default=list(SPLITS))
    for flag in ("--resume", "--validate-only", "--dry-run", "--keep-intermediate"):
        g.add_argument(flag, action="store_true")
    g.add_argument("--smoke-count", type=int, default=0)
    g.add_argument("--seed", type=int, default=0)
    g.add_argument("--record-id")
    g.add_argument("--progress-every", type=int, default=10)
    g.add_argument("--device", default="cpu")
    g.add_argument("--workers", type=int, default=0)
    v = sub.add_parser("validate")
    v.add_argument("--output-root", required=True)
    v.add_argument("--source-root", required=True)
    v.add_argument("--splits", nargs="+", default=list(SPLITS))
    r = sub.add_parser("repair-ids")
    r.add_argument("source")
    r.add_argument("target")
    m = sub.add_parser("migrate-checksums")
    m.add_argument("--output-root", required=True)
    m.add_argument("--seed", type=int, default=0)
    m.add_argument("--dry-run", action="store_true")
    return p


RUN = {"generate": run_generation, "validate": run_validation, "repair-ids": run_repair, "migrate-checksums": run_migration}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return RUN[args.command](build_session(), args)


if __name__ == "__main__":
    sys.exit(main())
