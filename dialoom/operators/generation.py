"""Making a record: pluggable speech functions, assembly of two channels, placements and alignments.

The speech models are outside; ``Synth`` and ``Align`` are plain Python functions that run once
for each row of an Arrow batch. Their errors become a row's reason, never a failed job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from dialoom.config import ALIGNED_SPEAKER, ALIGNMENT_TOLERANCE, BYTES_PER_SECOND, CHARS_PER_SECOND, LIMITER_CEILING, PAUSE_ESTIMATE, SPEECH_FLOOR, GenerationConfig
from dialoom.functions.signal import bind
from dialoom.functions.text import tokens
from dialoom.operators.assignment import language, pause_before, speed_of_turn, user_speed, user_voice, voice_of_turn

#: (text, voice, speed, language) -> chunks of samples; (samples, rate, text) -> (word, start, end, confidence).
Synth = Callable[[str, str, float, str], list]
Align = Callable[[np.ndarray, int, str], list]


def plan_turns(records: DataFrame, config: GenerationConfig) -> DataFrame:
    """One row a turn: (split, id, index, speaker, text, voice, speed, lang, pause)."""
    d = records.withColumn("user_voice", user_voice(F.col("id"), F.col("split"), config.seed))
    d = d.select("split", "id", "user_voice", F.posexplode("turns").alias("index", "t"))
    speaker = F.col("t.speaker")
    voice = voice_of_turn(speaker, F.col("user_voice"))
    speed = speed_of_turn(speaker, user_speed(F.col("id"), F.col("split"), F.col("index"), config.seed))
    return d.select("split", "id", "index", speaker.alias("speaker"), F.col("t.text").alias("text"), voice.alias("voice"), speed.alias("speed"), language(voice).alias("lang"), pause_before(F.col("id"), F.col("split"), F.col("index"), config.seed).alias("pause"))


def placements(turns: DataFrame, keys: tuple[str, ...], samples: Column, pause_samples: Column) -> DataFrame:
    """Adds start_sample and end_sample: a running sum of pauses and lengths in turn order."""
    w = Window.partitionBy(*keys).orderBy("index").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(pause_samples + samples).over(w)
    return turns.withColumn("end_sample", end.cast("long")).withColumn("start_sample", (F.col("end_sample") - samples).cast("long"))


def dry_run(records: DataFrame) -> DataFrame:
    """One row: dialogues, characters, and the hours and bytes to expect."""
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.length(t["text"]))
    g = records.agg(F.count("*").alias("dialogues"), F.coalesce(F.sum(chars), F.lit(0)).alias("chars"), (F.coalesce(F.sum(F.greatest(F.size("turns") - 1, F.lit(0))), F.lit(0)) * PAUSE_ESTIMATE).alias("pause_seconds"))
    g = g.withColumn("seconds", F.col("chars") / CHARS_PER_SECOND + F.col("pause_seconds"))
    return g.select("dialogues", "chars", "pause_seconds", F.round("seconds", 4).alias("seconds"), F.round(F.col("seconds") / 3600, 6).alias("hours"), F.floor(F.col("seconds") * BYTES_PER_SECOND).alias("bytes"))


def stub_synth(text: str, voice: str, speed: float, lang: str) -> list[np.ndarray]:
    """A tone as long as the text would take to say; for tests and dry runs."""
    seconds = max(0.2, len(text) / CHARS_PER_SECOND / speed)
    return [(0.3 * np.sin(2 * np.pi * 220 * np.arange(int(seconds * 24_000)) / 24_000)).astype(np.float32)]


def stub_align(samples: np.ndarray, rate: int, text: str) -> list[tuple[str, float, float, float]]:
    """Equal slices for the words."""
    import re

    from dialoom.functions.text import LETTERS

    words = [w for w in re.findall(f"[{LETTERS}']+", text) if w.strip("'")]
    step = len(samples) / rate / max(1, len(words))
    return [(w, k * step, (k + 1) * step - 1e-4, 0.9) for k, w in enumerate(words)]


def even_words(text: Column, seconds: Column, digits: int = 4) -> Column:
    """The same slices as a column expression: array of (word, start, end, confidence)."""
    def slices(b: Column) -> Column:
        step = b["seconds"] / F.greatest(F.size(b["words"]), F.lit(1))
        return F.transform(b["words"], lambda w, k: F.struct(w.alias("word"), F.round(k * step, digits).alias("start"), F.round((k + 1) * step - 1e-4, digits).alias("end"), F.lit(0.9).alias("confidence")))

    return bind(F.struct(tokens(text).alias("words"), seconds.alias("seconds")), slices)


GENERATED = (
    "split string, id string, reason string, left array<float>, right array<float>, duration_seconds double, placements array<struct<index:int,speaker:string,start_sample:bigint,end_sample:bigint>>, "
    "alignments array<struct<word:string,start:double,end:double,speaker:string>>, confidence_mean double, confidence_min double, flagged boolean, rms_left double, rms_right double, peak_left double, peak_right double"
)


def generate(records: DataFrame, config: GenerationConfig, synth: Synth = stub_synth, align: Align = stub_align, pronunciations: dict[str, str] | None = None) -> DataFrame:
    """Records as sound (``GENERATED``); the first failing step's reason, null where all went well.

    A record's turns travel as one row, so nothing is exploded by sample and
    assembly is vectorised. Put the list of work first: an expensive function must not see
    rows that are done already.
    """
    from dialoom.functions.text import pronounce

    turns = plan_turns(records, config)
    spoken = pronounce(F.col("text"), pronunciations) if pronunciations else F.col("text")
    one = turns.withColumn("spoken", spoken).groupBy("split", "id").agg(F.sort_array(F.collect_list(F.struct("index", "speaker", "text", "spoken", "voice", "speed", "lang", "pause"))).alias("turns"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [make(s, i, t, config, synth, align) for s, i, t in zip(b["split"], b["id"], b["turns"])]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _columns()])

    # One dialogue may be ten minutes of sound: few rows to a batch, spread over the cluster.
    return one.repartition("split", "id").mapInPandas(run, GENERATED)


def _columns() -> list[str]:
    return ["split", "id", "reason", "left", "right", "duration_seconds", "placements", "alignments", "confidence_mean", "confidence_min", "flagged", "rms_left", "rms_right", "peak_left", "peak_right"]


def envelope(lengths: list[int], rate: int, seconds: float) -> np.ndarray:
    """Weights of the samples of utterances end to end: each rises from nothing and falls back to it."""
    n = np.repeat(lengths, lengths)
    k = np.arange(len(n)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    ramp = np.minimum(round(rate * seconds), n // 2)
    edge = np.minimum(k, n - 1 - k) / np.maximum(ramp - 1, 1)
    return np.where(ramp > 0, np.minimum(edge, 1.0), 1.0).astype(np.float32)


def gain(tracks: np.ndarray) -> np.ndarray:
    """What each track is multiplied by so that none passes full scale."""
    top = np.abs(tracks).max(axis=1, initial=0.0)
    return np.where(top > 1, LIMITER_CEILING / np.maximum(top, 1.0), 1.0).astype(np.float32)


def aligned_reason(words: list[tuple[str, float, float, float]], seconds: float) -> str | None:
    """What is wrong with the words of one utterance: none, or times and scores that aren't finite, run backwards or leave it."""
    if not words:
        return "no words"
    t = np.array([w[1:] for w in words], float)
    if not np.isfinite(t).all():
        return "times and scores must be finite"
    if any(not str(w[0]).strip() for w in words):
        return "words must be nonempty"
    if (t[:, 1] <= t[:, 0]).any() or (t[1:, 0] < t[:-1, 1] - 1e-9).any() or t[0, 0] < 0:
        return "times must go forward"
    if t[-1, 1] > seconds + ALIGNMENT_TOLERANCE:
        return "times end after the sound"
    return None


def make(split: str, id_: str, turns, config: GenerationConfig, synth: Synth, align: Align) -> tuple:
    rate = config.sample_rate

    def failed(reason: str) -> tuple:
        return (split, id_, reason, *[None] * 12)

    pieces = []
    for t in turns:
        try:
            chunks = [np.asarray(c, np.float32) for c in synth(t["spoken"], t["voice"], t["speed"], t["lang"])]
            if not chunks:
                raise ValueError("no sound")
        except Exception as e:  # noqa: BLE001 - a model's error is the record's reason
            return failed(f"turn[{t['index']}] synthesis failed: {e}")
        gap = np.zeros(round(rate * config.chunk_pause_seconds), np.float32)
        x = np.concatenate([y for k, c in enumerate(chunks) for y in ((gap, c) if k else (c,))])
        if len(x) < int(config.min_utterance_seconds * rate):
            return failed(f"turn[{t['index']}] is too short")
        if not np.isfinite(x).all():
            return failed(f"turn[{t['index']}] has non-finite samples")
        pieces.append((t, x))
    total, places = 0, []
    for t, x in pieces:
        start = total + round(t["pause"] * rate)
        total = start + len(x)
        places.append({"index": int(t["index"]), "speaker": t["speaker"], "start_sample": start, "end_sample": total})
    if total / rate > config.max_dialogue_seconds:
        return failed("dialogue is too long")
    shape = np.split(envelope([len(x) for _, x in pieces], rate, config.fade_seconds), np.cumsum([len(x) for _, x in pieces])[:-1])
    tracks = np.zeros((2, total), np.float32)
    for p, (t, x), w in zip(places, pieces, shape):
        tracks[int(t["speaker"] != "assistant"), p["start_sample"] : p["end_sample"]] = x * w
    left, right = loud = tracks * gain(tracks)[:, None]
    if np.abs(loud).max(initial=0.0) >= config.clipping_peak_threshold:
        return failed("clipping after assembly")
    aligned, scores = [], []
    for p, (t, x) in zip(places, pieces):
        if t["speaker"] != "assistant":
            continue
        try:
            words = align(tracks[0, p["start_sample"] : p["end_sample"]], rate, t["text"])
        except Exception as e:  # noqa: BLE001
            return failed(f"turn[{t['index']}] alignment failed: {e}")
        if wrong := aligned_reason(words, len(x) / rate):
            return failed(f"turn[{t['index']}] alignment failed: {wrong}")
        at = p["start_sample"] / rate
        aligned += [{"word": w, "start": round(at + a, 4), "end": round(at + z, 4), "speaker": ALIGNED_SPEAKER} for w, a, z, _ in words]
        scores += [c for *_, c in words]
    mean, low = (float(np.mean(scores)), float(np.min(scores))) if scores else (0.0, 0.0)
    power = [float(np.sqrt(np.mean(np.square(x, dtype=np.float64)))) if len(x) else 0.0 for x in (left, right)]
    tops = [float(np.abs(x).max()) if len(x) else 0.0 for x in (left, right)]
    return (split, id_, None, left, right, total / rate, places, aligned, mean, low, mean < config.alignment_min_confidence, *power, *tops)


def speech(peak: Column) -> Column:
    return ~F.isnan(peak) & (peak > SPEECH_FLOOR)
