"""Tables and reports written so that a reader never sees half of one."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: What is added to a table's name while it is swapped.
ASIDE = ".before"


def replace(df: DataFrame, path: str, form: str = "parquet") -> None:
    """Swap a whole table: written beside the old one, which is set aside until the new one has its name.

    The table may be read in the plan. A run that ends between the two renames leaves the old
    table set aside; ``settle`` puts it back.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    stage, target = jvm.org.apache.hadoop.fs.Path(f"{path}.staging-{uuid.uuid4().hex}"), jvm.org.apache.hadoop.fs.Path(path)
    df.write.format(form).save(stage.toString())
    fs, aside = target.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(path + ASIDE)
    settle(spark, path)
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(stage, target):
        raise OSError(f"could not rename {stage} to {path}")
    fs.delete(aside, True)


def settle(spark: SparkSession, path: str) -> None:
    """Finish a swap that was cut off: a table set aside goes back if nothing has its name, else it goes."""
    jvm = spark._jvm
    target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ASIDE)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(aside):
        if fs.exists(target):
            fs.delete(aside, True)
        else:
            fs.rename(aside, target)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def append(df: DataFrame, path: str, form: str = "json") -> None:
    df.write.format(form).mode("append").save(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file by a hidden one and a rename, in any store that Spark can write."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(path)
    fs = target.getFileSystem(conf)
    part = Path(target.getParent(), f".{target.getName()}.tmp-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.hsync()
    out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"could not rename to {path}")


def plain(value):
    """A value for JSON: rows as dicts, NaN and infinities as null."""
    if hasattr(value, "asDict"):
        value = value.asDict(True)
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


def write_report(spark: SparkSession, path: str, report) -> None:
    write_text(spark, path, json.dumps(plain(report), indent=2, ensure_ascii=False))


def write_manifests(lines: DataFrame, root: str) -> None:
    """``lines(split, line_no, path, duration)``: one ordered JSON-lines file a split."""
    for (split,) in lines.select("split").distinct().collect():  # a handful of splits
        part = lines.where(F.col("split") == split).orderBy("line_no").select("path", "duration")
        replace(part.coalesce(1), f"{root}/{split}/manifest", "json")


def companion(df: DataFrame) -> DataFrame:
    """(split, id, json): records as JSON text; NaN becomes null."""
    cols = [F.when(~F.isnan(c), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    return df.select("split", "id", F.to_json(F.struct(*cols)).alias("json"))


def dataset_card(name: str, generation: dict | None, qa: dict | None, provenance: dict | None) -> str:
    """A short description; each figure comes from the first report that has it."""
    def first(key: str, *sources: dict | None):
        return next((s[key] for s in sources if s and s.get(key) is not None), "unknown")

    rows = [("Dialogues", first("dialogues", generation, qa)), ("Hours", first("hours", generation, qa)), ("Valid, percent", first("completion_percent", qa)), ("Created with Spark", first("spark", provenance))]
    return f"# {name}\n\n" + "\n".join(f"- {k}: {v}" for k, v in rows) + "\n"
