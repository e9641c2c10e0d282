"""Rules, sampling, increments, reports and the whole run, on small dialogues."""

import json
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dialoom import cli
from dialoom.config import CATEGORIES, VOICE_POOLS, GenerationConfig
from dialoom.operators import assignment, generation, incremental, qa, sampling, validation
from dialoom.sources import dialogues, sinks, wav
from dialoom.streaming import receipts as stream

DIALOGUE = "split string, id string, category string, turns array<struct<speaker:string,text:string>>, line_no long"


def turns(n=4):
    return [("user" if k % 2 == 0 else "assistant", f"This is turn number {k}.") for k in range(n)]


def record(id_="r1", n=4, **more):
    return {"id": id_, "category": CATEGORIES[0], "turns": [{"speaker": s, "text": t} for s, t in turns(n)]} | more


def write_tree(root, **splits):
    root.mkdir(parents=True, exist_ok=True)
    for name, rows in splits.items():
        (root / f"{name}.jsonl").write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
    return str(root)


def problems(tree):
    return {(r.ref, r.reason) for r in tree.problems.collect()}


def test_source_rules(spark, tmp_path):
    bad = [
        ("x1", record("x1") | {"turns": record()["turns"][:3]}, "turns must have an even count between 2 and 8, got 3"),
        ("x2", record("x2", category="nope"), "category 'nope' is not in the allowed category set"),
        ("x3", record("x3", extra=1), "unexpected keys (extra=['extra'], missing=[])"),
        ("train.jsonl:L4", {"id": 1, "category": CATEGORIES[0], "turns": record()["turns"]}, "id must be a nonempty string"),
        ("x5", record("x5") | {"turns": []}, "turns must be a nonempty list"),
        ("x6", record("x6") | {"turns": record()["turns"][::-1]}, "first speaker must be 'user'"),
        ("x7", record("x7") | {"turns": [record()["turns"][k] for k in (0, 0, 1, 1)]}, "turn[1] does not alternate speaker with turn[0]"),
        ("x8", record("x8") | {"turns": [{"speaker": "user", "text": "see www.x.y"}, {"speaker": "assistant", "text": "..."}]}, "turn[0] contains a URL"),
        ("x8", None, "turn[1] normalizes to an empty forced-alignment transcript"),
        ("x9", record("x9") | {"turns": [{"speaker": "user", "text": "a", "more": 1}, {"speaker": "bot", "text": " "}]}, "turn[0] must have exactly keys 'speaker' and 'text'"),
        ("x9", None, "turn[1] has invalid speaker 'bot'"),
        ("x9", None, "turn[1] text must be nonempty"),
    ]
    rows = [b for _, b, _ in bad if b is not None]
    root = write_tree(tmp_path / "s", train=[*rows, "", "{not json", "[1]", record("good"), record("good")], validation=[record("v"), record("good")])
    tree = validation.check_tree(spark, root, expected={})
    got = problems(tree)
    assert {(ref, why) for ref, _, why in bad} <= got
    assert ("train.jsonl:L11", "invalid JSON") in got and ("train.jsonl:L12", "record must be a JSON object") in got
    assert ("good", "duplicate id within train") in got and ("good", "id appears in both 'train' and 'validation' (split overlap)") in got
    assert ("test", f"missing authoritative split file: {root}/test.jsonl") in got
    assert not any(ref == "v" for ref, _ in got)
    with pytest.raises(validation.SourceInvalid):
        validation.require_valid(tree)
    counted = validation.check_tree(spark, root, ("validation",))
    assert ("validation", "expected 150 records, found 2") in problems(counted)


def test_alignments(spark):
    ok = ("w", 0.0, 1.0, "SPEAKER_MAIN")
    nan = float("nan")
    rows = [(0, *ok), (1, "", 1.0, 2.0, "SPEAKER_MAIN"), (2, "w", nan, 3.0, "SPEAKER_MAIN"), (3, "w", 1.5, 1.4, "X"), (4, "w", 3.0, 9.0, "SPEAKER_MAIN"), (5, "w", -1.0, 9.5, "SPEAKER_MAIN")]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, pos long, word string, start double, end double, speaker string")
    long = {(r.pos, r.reason.split("]", 1)[1]) for r in validation.alignment_violations(df, ("k",), F.lit(9.0)).collect()}
    assert long == {
        (1, ".word must be a nonempty string"), (2, " timestamps must be finite"), (3, ".speaker must be 'SPEAKER_MAIN'"), (3, " end must be greater than start"), (3, " start is before the previous end"),
        (5, " start must be nonnegative"), (5, " end exceeds duration"), (5, " start is before the previous end"),
    }
    arr = df.groupBy("k").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word", "start", "end", "speaker"))), lambda x: F.struct(x["word"].alias("word"), x["start"].alias("start"), x["end"].alias("end"), x["speaker"].alias("speaker"))).alias("a"))
    wide = arr.select(validation.alignment_reasons(F.col("a"), F.lit(9.0)).alias("r")).first().r
    assert sorted(wide) == sorted(f"alignments[{p}]{m}" for p, m in long)
    none = spark.range(1).select(validation.alignment_reasons(F.lit(None).cast("array<struct<word:string,start:double,end:double,speaker:string>>"), F.lit(1.0)).alias("r")).first().r
    assert none == ["alignments must be nonempty"]


def test_voices(spark):
    df = spark.createDataFrame([(s, f"{s}{k}") for s in VOICE_POOLS for k in range(60)], "split string, id string")
    one = {(r.split, r.id): r.v for r in df.repartition(1).select("split", "id", assignment.user_voice(F.col("id"), F.col("split")).alias("v")).collect()}
    many = {(r.split, r.id): r.v for r in df.repartition(16).select("split", "id", assignment.user_voice(F.col("id"), F.col("split")).alias("v")).collect()}
    assert one == many and all(v in VOICE_POOLS[s] for (s, _), v in one.items())
    numpy = df.select("split", "id", assignment.numpy_voice()("id", "split").alias("v")).collect()
    assert all(r.v in VOICE_POOLS[r.split] for r in numpy)
    assert df.limit(1).select(assignment.numpy_voice()(F.lit("batch_0001_0001"), F.lit("train")).alias("v")).first().v == VOICE_POOLS["train"][17]
    assert df.select(assignment.language(F.lit("bf_x")).alias("l")).first().l == "b"
    with pytest.raises(Exception, match="no language"):
        df.select(assignment.language(F.lit("zf_x")).alias("l")).collect()
    with pytest.raises(Exception, match="no voice pool"):
        df.select(assignment.user_voice(F.col("id"), F.lit("other")).alias("l")).collect()
    assert validation.pool_problems(validation.pool_table(spark)).count() == 0


def population(spark, **sizes):
    rows = [(s, f"{s[:2]}_{k:04d}", CATEGORIES[k % 6]) for s, n in sizes.items() for k in range(n)]
    return spark.createDataFrame(rows, "split string, id string, category string")


def test_targets():
    pools = {s: len(v) for s, v in VOICE_POOLS.items()}
    assert sum(sampling.split_targets({"train": 2700, "validation": 150, "test": 150}, pools, 50).values()) == 50
    assert sampling.split_targets({"train": 2, "validation": 1, "test": 1}, pools, 50) == {"train": 2, "validation": 1, "test": 1}
    assert sampling.split_targets({"train": 100, "validation": 50, "test": 50}, pools, 10) == {"train": 5, "validation": 3, "test": 2}
    got = sampling.split_targets({"train": 20, "validation": 5, "test": 400}, pools, 60)
    assert sum(got.values()) == 60 and got["train"] <= 20 and got["validation"] <= 5


def test_subset(spark):
    big = population(spark, train=300, validation=60, test=60)
    s = sampling.stratified(big, 50)
    ids = sorted((r.split, r.id) for r in s.selected.collect())
    assert len(ids) == len(set(ids)) == 50
    assert all(r.covered for r in s.categories.collect()) and all(r.covered for r in s.voices.collect())
    assert ids == sorted((r.split, r.id) for r in sampling.stratified(big.repartition(7), 50).selected.collect())
    tiny = sampling.stratified(population(spark, train=2, validation=1, test=1), 50)
    assert tiny.selected.count() == 4 and not all(r.covered for r in tiny.voices.collect())


def test_shards(spark):
    for n, rows in ((3, 10), (4, 2), (2, 0)):
        got = [r.shard for r in sampling.shards(spark.range(rows), n, ["id"]).collect()]
        counts = [got.count(k) for k in range(n)]
        assert sum(counts) == rows and max(counts) - min(counts) <= 1


def test_compaction_and_repair(spark):
    log = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, None)], "id string, seq long, v string")
    assert {(r.id, r.seq, r.v) for r in incremental.latest(log, "id", "seq").collect()} == {("a", 3, None), ("b", 2, "y")}
    ids = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("a", 4)], "id string, at long")
    assert [r.new_id for r in incremental.repair_ids(ids, "id", "at").orderBy("at").collect()] == ["a", "a__dup2", "b", "a__dup3"]
    new, n = incremental.migrate(log, spark.createDataFrame([("a", "z")], "id string, v string"), ["id"], "v")
    assert n.first().n_changed == 2 and sorted(r.v for r in new.collect()) == ["y", "z", "z"]


def test_wav_round_trip(spark, tmp_path):
    rows = [("train", "a", [0.0, 0.5, -1.0], [1.0, 0.0, 0.25])]
    wav.write(spark.createDataFrame(rows, "split string, id string, left array<float>, right array<float>"), str(tmp_path), 8000)
    (tmp_path / "train/audio/bad.wav").write_bytes(b"nothing")
    (tmp_path / "train/audio/.x.wav.tmp-1").write_bytes(b"")
    got = {Path(r.path).stem: r for r in wav.read(spark, str(tmp_path / "train/audio")).collect()}
    assert (got["a"].sample_rate, got["a"].channels, got["a"].n_frames) == (8000, 2, 3)
    assert got["a"].left == pytest.approx([0, 0.5, -1.0], abs=1e-4) and got["bad"].error
    assert dialogues.leftovers(spark, str(tmp_path), "train") == [".x.wav.tmp-1"]
    assert {r.id for r in dialogues.read_ids(spark, str(tmp_path), "train").collect()} == {"a", "bad"}
    with pytest.raises(ValueError):
        wav.encode([0.0], [0.0, 1.0], 8000)


def test_placements_and_layout(spark):
    config = GenerationConfig()
    t = [{"index": k, "speaker": s, "text": x, "spoken": x, "voice": "v", "speed": 1.0, "lang": "a", "pause": 0.5 if k else 0.0} for k, (s, x) in enumerate(turns(2))]
    r = dict(zip(generation._columns(), generation.make("train", "x", t, config, generation.stub_synth, generation.stub_align)))
    a, b = r["placements"]
    assert r["reason"] is None and b["start_sample"] == a["end_sample"] + 12_000 and len(r["left"]) == len(r["right"]) == b["end_sample"]
    assert not r["left"][: b["start_sample"]].any() and not r["right"][a["end_sample"] :].any() and r["confidence_mean"] == pytest.approx(0.9)
    assert "synthesis failed: boom" in generation.make("train", "x", t, config, lambda *a: (_ for _ in ()).throw(ValueError("boom")), generation.stub_align)[2]
    assert "too short" in generation.make("train", "x", t, config, lambda *a: [[0.1]], generation.stub_align)[2]


def test_reports(spark):
    checks = spark.createDataFrame(
        [("train", "a", True, [], 3600.0, "v1", "c1"), ("train", "b", False, ["p"], 7200.0, "v1", "c1"), ("test", "c", True, [], 1800.0, "", "")],
        "split string, id string, ok boolean, problems array<string>, duration_seconds double, user_voice string, category string",
    )
    s = {r.split: r for r in qa.split_summary(checks).collect()}
    assert (s["train"].found, s["train"].valid, s["train"].invalid, s["train"].hours, s["train"].p50) == (2, 1, 1, 1.0, 3600.0)
    assert {(r.category, r.hours) for r in qa.category_hours(checks).collect()} == {("c1", 1.0), ("unknown", 0.5)}
    assert [(r.user_voice, r.n) for r in qa.voice_distribution(checks).collect()] == [("v1", 1)]
    assert qa.completion(checks.where("ok"), checks.limit(0)).first().completion_percent is None
    assert {(r.split, r.verdict) for r in qa.verdict(checks, spark, {"train": 2, "test": 1, "validation": 1}).collect()} == {("train", "invalid"), ("test", "complete"), ("validation", "incomplete")}


def test_progress(spark):
    done = spark.createDataFrame([(True, 0.0, 30.0), (False, 0.0, 60.0)], "ok boolean, started double, finished double")
    r = stream.progress(done, 10).first()
    assert (r.completed, r.failed, r.per_minute, r.eta_seconds) == (1, 1, 2.0, 240.0)
    assert math.isinf(stream.progress(done.limit(0), 10).first().eta_seconds)


def test_stream_compaction(spark, tmp_path):
    schema, log, table = "id string, seq long, v string", str(tmp_path / "log"), str(tmp_path / "table")
    for batch in ([("a", 1, "x"), ("b", 1, "y")], [("a", 2, "z")]):
        sinks.append(spark.createDataFrame(batch, schema), log)
        q = stream.compact(stream.read(spark, log, schema), table, str(tmp_path / "checkpoint"))
        q.awaitTermination()
    assert {(r.id, r.v) for r in spark.read.parquet(table).collect()} == {("a", "z"), ("b", "y")}


def test_reports_never_hold_nan(spark, tmp_path):
    path = str(tmp_path / "r.json")
    sinks.write_report(spark, path, {"a": float("nan"), "b": [1.0, float("inf")]})
    assert json.loads(Path(path).read_text()) == {"a": None, "b": [1.0, None]}
    assert "unknown" in sinks.dataset_card("x", None, None, None)


def test_whole_run(spark, tmp_path):
    root = write_tree(tmp_path / "src", train=[record(f"t{k}", 2) for k in range(3)], validation=[record("v0", 2)], test=[record("e0", 2)])
    out = str(tmp_path / "out")
    args = ["generate", "--source-root", root, "--output-root", out, "--smoke-count", "5"]
    assert cli.run_generation(spark, cli.parser().parse_args([*args, "--dry-run"])) == 0
    assert cli.run_generation(spark, cli.parser().parse_args(args)) == 0
    assert len(list(Path(out).glob("*/audio/*.wav"))) == 5
    import hashlib

    sums = {(r.split, r.id): (r.wav_checksum, r.json_checksum) for r in cli.receipts(spark, out).collect()}
    assert len(sums) == 5 and all(x and y for x, y in sums.values())
    assert all(hashlib.sha256(p.read_bytes()).hexdigest() == sums[p.parent.parent.name, p.stem][0] for p in Path(out).glob("*/audio/*.wav"))
    check = cli.parser().parse_args(["validate", "--source-root", root, "--output-root", out])
    assert cli.run_validation(spark, check) == 0, json.loads((Path(out) / "qa_summary.json").read_text())
    stamps = {p: p.stat().st_mtime_ns for p in Path(out).glob("*/audio/*.wav")}
    (Path(out) / "train/audio/t1.wav").write_bytes(b"broken")
    assert cli.run_validation(spark, check) == 1
    assert cli.run_generation(spark, cli.parser().parse_args([*args, "--resume"])) == 0
    assert [p.stem for p, t in stamps.items() if p.stat().st_mtime_ns != t] == ["t1"]  # only what was broken is made again
    assert cli.run_validation(spark, check) == 0
    assert cli.run_migration(spark, cli.parser().parse_args(["migrate-checksums", "--output-root", out, "--seed", "1", "--dry-run"])) == 0
    assert cli.run_generation(spark, cli.parser().parse_args(["generate", "--source-root", root, "--output-root", out])) == 1  # counts


def test_generation_guards(spark, tmp_path):
    """What the aligner or the assembly gets wrong is the record's reason, and leaves no file and no receipt."""
    config = GenerationConfig()
    row = lambda s, t: {"index": 0, "speaker": s, "text": t, "spoken": t, "voice": "af_heart", "speed": 1.0, "lang": "a", "pause": 0.0}
    said = [row("user", "hi there"), row("assistant", "hello to you")]
    reason = lambda align, c=config: generation.make("train", "x", said, c, generation.stub_synth, align)[2]
    assert reason(generation.stub_align) is None
    bad = {"no words": [], "finite": [("a", float("nan"), 1.0, 0.9)], "forward": [("a", 0.2, 0.1, 0.9)], "after": [("a", 0.0, 99.0, 0.9)], "nonempty": [(" ", 0.0, 0.1, 0.9)]}
    for part, words in bad.items():
        assert part in reason(lambda x, r, t, words=words: words)
    assert reason(lambda *a: 1 / 0).endswith("division by zero")
    assert reason(generation.stub_align, GenerationConfig(clipping_peak_threshold=1e-6)) == "clipping after assembly"
    root, out = write_tree(tmp_path / "src", train=[record("t0", 2)], validation=[record("v0", 2)], test=[record("e0", 2)]), str(tmp_path / "out")
    cli.run_generation(spark, cli.parser().parse_args(["generate", "--source-root", root, "--output-root", out, "--smoke-count", "3"]), align=lambda *a: [])
    assert not list(Path(out).glob("*/audio/*.wav")) and cli.receipts(spark, out).count() == 0


def test_envelope_and_gain_are_the_column_functions(spark):
    import numpy as np

    from dialoom.functions import signal

    rng = np.random.default_rng(4)
    parts = [rng.normal(size=n).astype(np.float32) * s for n, s in ((64, 1), (5, 3), (1, 1), (200, 0.1))]
    shape = np.split(generation.envelope([len(x) for x in parts], 1000, 0.012), np.cumsum([len(x) for x in parts])[:-1])
    for x, w in zip(parts, shape):
        want = spark.createDataFrame([(x.tolist(),)], "s array<float>").select(signal.fade(F.col("s"), 1000, 0.012).alias("f")).first().f
        assert np.allclose(x * w, want, atol=1e-5)
    tracks = np.stack([parts[3], parts[3] * 100])
    want = [spark.createDataFrame([(x.tolist(),)], "s array<float>").select(signal.limit(F.col("s")).alias("f")).first().f for x in tracks]
    assert np.allclose(tracks * generation.gain(tracks)[:, None], want, atol=1e-4)


def test_limits_keep_finished_work():
    from dialoom.functions.hashing import config_checksum

    same = lambda **k: config_checksum(GenerationConfig(**k).audio_dict(), "train", "v") == config_checksum(GenerationConfig().audio_dict(), "train", "v")
    assert same(max_dialogue_seconds=5.0, min_utterance_seconds=1.0, alignment_min_confidence=0.1) and not same(fade_seconds=0.1)


def test_swaps_and_the_last_line(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(3):
        sinks.replace(spark.createDataFrame([(k,)], "k long"), path)
    Path(path).rename(path + sinks.ASIDE)  # a run that ended between the renames
    sinks.settle(spark, path)
    assert spark.read.parquet(path).first().k == 2
    sinks.replace(spark.read.parquet(path).withColumn("k", F.col("k") + 1), path)
    assert spark.read.parquet(path).first().k == 3 and [p.name for p in tmp_path.iterdir()] == ["t"]
    log = str(tmp_path / "log")
    for k in range(4):
        sinks.append(spark.createDataFrame([("a", float(k)), ("a", k + 0.5), ("b", float(-k))], "path string, duration double").coalesce(1), log)
    last = incremental.latest(dialogues.read_log(spark, log, "path string, duration double", placed=True), "path", "at")
    assert {r.path: r.duration for r in last.collect()} == {"a": 3.5, "b": -3.0}
