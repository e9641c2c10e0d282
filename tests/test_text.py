"""Text gates, tokens, hashes and signals as column expressions."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dialoom.config import GenerationConfig
from dialoom.functions import hashing, signal, stats, text as tx


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "gate, yes, no",
    [
        (tx.has_control, ["a\nb", "a\tb", "​", "͸", ""], ["plain", "é—…"]),
        (tx.has_unsupported, ["×", "÷", "Ω", " ", "日"], ["café ‘x’ “y” — –…", "~"]),
        (tx.has_url, ["see HTTP://x.y", "www.a"], ["www. a", "http:// x", "htp://x"]),
        (tx.has_markdown, ["**b**", "_em_ x", "`c`", "# h", "- b", "* b", "[a](b)"], ["a_b_c", "é_b_", "2 * 3", "x # y", "[a] (b)"]),
        (tx.too_long, ["x" * 401, "🙂" * 401], ["x" * 400, "🙂" * 400]),
        (tx.is_blank, ["", " \t\n", "  ", "\x1c\x85"], ["a", "."]),
    ],
)
def test_gates(spark, gate, yes, no):
    assert all(one(spark, t, gate) for t in yes)
    assert not any(one(spark, t, gate) for t in no)


def test_tokens(spark):
    assert one(spark, "It's café-time, '' 'tis × 42!", tx.tokens) == ["It's", "café", "time", "'tis"]
    assert one(spark, "... '' 12", tx.tokens) == []
    assert one(spark, "Naïve'S", tx.spoken) == "naive's"
    assert one(spark, "Æøß", tx.spoken) == ""


def test_pronounce(spark):
    say = {"Foo": "fuː", "Foo Bar": "fb"}
    assert one(spark, "A foo and FOO, not éfoo or foofoo.", lambda c: tx.pronounce(c, {"Foo": "fuː"})) == "A [foo](/fuː/) and [FOO](/fuː/), not éfoo or foofoo."
    assert one(spark, "Foo Bar", lambda c: tx.pronounce(c, say)).startswith("[")


def test_offending_and_hms(spark):
    assert one(spark, "aé…Ω", tx.offending) == ["é", "Ω"]
    assert one(spark, "é", tx.code_point) == "U+00E9"
    for s, want in ((0.0, "00:00:00"), (-5.0, "00:00:00"), (3661.9, "01:01:01"), (360000.0, "100:00:00")):
        assert one(spark, s, tx.format_hms, "double") == want


def test_dialogue_checksum_is_canonical_json(spark):
    turns = [("user", 'q "x" \\ é'), ("assistant", "🙂 ok\n")]
    df = spark.createDataFrame([("d1", "c", turns, 7)], "id string, category string, turns array<struct<speaker:string,text:string>>, extra int")
    got = df.select(hashing.dialogue_checksum(F.col("category"), F.col("id"), F.col("turns")).alias("h")).first().h
    doc = {"id": "d1", "category": "c", "turns": [{"speaker": s, "text": t} for s, t in turns]}
    assert got == hashlib.sha256(json.dumps(doc, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()).hexdigest()


def test_config_checksum_ignores_gates():
    a, b, c = GenerationConfig(), GenerationConfig(alignment_min_confidence=0.9), GenerationConfig(seed=1)
    h = lambda x: hashing.config_checksum(x.audio_dict(), "train", "v")
    assert h(a) == h(b) != h(c)


def test_seed(spark):
    got = one(spark, "x", lambda c: hashing.seed_int(0, c, "p"))
    assert int(got) == int.from_bytes(hashlib.sha256(b"0|x|p").digest()[:8], "big")
    u = spark.range(500).select(hashing.uniform(hashing.seed_int(F.col("id")), 0.92, 1.08).alias("u")).toPandas().u
    assert u.between(0.92, 1.08).all() and u.nunique() == 500


def test_signals(spark):
    nan, inf = float("nan"), float("inf")
    arr = "array<double>"
    assert one(spark, [], signal.peak, arr) == 0 and one(spark, [], signal.rms, arr) == 0
    assert one(spark, [0.5, -2.0], signal.peak, arr) == 2.0
    assert abs(one(spark, [3.0, 4.0], signal.rms, arr) - math.sqrt(12.5)) < 1e-12
    assert not one(spark, [nan, 5.0], lambda c: signal.clips(c, 1.0), arr) and not one(spark, [nan], signal.has_speech, arr)
    assert one(spark, [1.0], lambda c: signal.clips(c, 1.0), arr) and not one(spark, [1e-4], signal.has_speech, arr)
    assert not one(spark, [0.1, inf], signal.all_finite, arr) and one(spark, [0.1], signal.all_finite, arr)
    assert one(spark, [2.0, -1.0], signal.limit, arr) == pytest.approx([0.98, -0.49]) and one(spark, [0.5], signal.limit, arr) == [0.5]
    assert one(spark, [1.0, -1.0, 2.0, 0.5], signal.pcm16, arr) == [32767, -32767, 32767, 16383]
    x = np.ones(20)
    ramp = np.linspace(0, 1, 5)
    x[:5] *= ramp
    x[-5:] *= ramp[::-1]
    assert one(spark, [1.0] * 20, lambda c: signal.fade(c, 1000, 0.005), arr) == pytest.approx(x.tolist())
    assert one(spark, [1.0], lambda c: signal.fade(c, 1000, 0.005), arr) == [1.0]
    assert one(spark, [[1.0], [2.0]], lambda c: signal.join_chunks(c, 10, 0.2), "array<array<float>>") == [1.0, 0.0, 0.0, 2.0]
    assert one(spark, [[1.0]], lambda c: signal.join_chunks(c, 10, 0.2), "array<array<float>>") == [1.0]


def test_percentiles(spark):
    def of(values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(*[c.alias(k) for k, c in stats.percentiles(F.col("v")).items()]).first()

    r = of([1.0, 2.0, 3.0, 4.0, 5.0])
    assert (r.p0, r.p25, r.p50, r.p90, r.p100) == (1.0, 2.0, 3.0, 4.6, 5.0)
    assert of([7.0]).p95 == 7.0
    assert math.isnan(of([]).p50)
