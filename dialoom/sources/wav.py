"""Reading and writing 16-bit PCM sound files on the executors."""

from __future__ import annotations

import io
import os
import uuid
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DECODED = "path string, sample_rate int, channels int, n_frames long, left array<float>, right array<float>, error string"


def decode(content: bytes) -> tuple[int, int, int, np.ndarray, np.ndarray]:
    """(rate, channels, frames, left, right); a mono file has its one channel on both sides."""
    with wave.open(io.BytesIO(content)) as w:
        if w.getsampwidth() != 2:
            raise ValueError(f"{8 * w.getsampwidth()}-bit samples are not read")
        data = np.frombuffer(w.readframes(w.getnframes()), "<i2").reshape(-1, w.getnchannels())
        x = (data / 32768).astype(np.float32)
        return w.getframerate(), w.getnchannels(), len(x), x[:, 0], x[:, min(1, x.shape[1] - 1)]


def encode(left, right, rate: int) -> bytes:
    left, right = np.asarray(left, np.float64), np.asarray(right, np.float64)
    if left.ndim != 1 or left.shape != right.shape:
        raise ValueError("two channels of one length are needed")
    both = (np.clip(np.stack([left, right], 1), -1, 1) * 32767).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(both.tobytes())
    return out.getvalue()


def read(spark: SparkSession, paths: str) -> DataFrame:
    """Sound files as rows; one that can't be decoded has its reason in ``error``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    rows.append((path, *decode(content), None))
                except Exception as e:  # noqa: BLE001 - any failure means the file isn't usable
                    rows.append((path, None, None, None, None, None, str(e) or type(e).__name__))
            yield pd.DataFrame(rows, columns=["path", "sample_rate", "channels", "n_frames", "left", "right", "error"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(paths).select("path", "content").mapInPandas(run, DECODED)


def seconds(n_frames: Column, rate: Column) -> Column:
    return F.when(rate > 0, n_frames / rate).otherwise(F.lit(0.0))


def write(signals: DataFrame, root: str, rate: int) -> None:
    """Write ``signals(split, id, left, right)`` as ``root/split/audio/id.wav``, each by a hidden file and a rename.

    For a root that all executors mount. A task that runs again writes the same files.
    """
    def run(rows) -> None:
        for r in rows:
            folder = f"{root}/{r.split}/audio"
            os.makedirs(folder, exist_ok=True)
            part = f"{folder}/.{r.id}.wav.tmp-{uuid.uuid4().hex}"
            with open(part, "wb") as f:
                f.write(encode(r.left, r.right, rate))
                f.flush()
                os.fsync(f.fileno())
            os.replace(part, f"{folder}/{r.id}.wav")

    signals.select("split", "id", "left", "right").foreachPartition(run)
