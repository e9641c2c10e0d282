"""Dialogue tables: read tolerantly from JSON lines, or made from turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dialoom.config import CATEGORIES, SPLITS

TURNS = "array<struct<speaker:string,text:string>>"


def exists(spark: SparkSession, path: str) -> bool:
    """Through Spark's file systems, so that any store the session can read counts."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones included (Spark's readers pass those over); empty if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line): numbered from 1, blank lines counted and then left out.

    Line numbers need the file as one value; a split file has a few thousand lines.
    """
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split("value", "\r\n|\r|\n")).alias("at", "line"))
    return lines.select((F.col("at") + 1).cast("long").alias("line_no"), "line").where(~F.col("line").rlike(r"^[\s\p{Z}\x1c-\x1f\x85]*$"))


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame | None:
    """Raw records of a split: (split, ref, line_no, v variant); null v: not JSON. None if there is no file."""
    path = f"{root.rstrip('/')}/{split}.jsonl"
    if not exists(spark, path):
        return None
    v = F.try_parse_json("line")
    id_ = F.when(F.schema_of_variant(F.try_variant_get(v, "$.id", "variant")) == "STRING", F.try_variant_get(v, "$.id", "string"))
    ref = F.coalesce(id_, F.concat(F.lit(f"{split}.jsonl:L"), F.col("line_no").cast("string")))
    return read_lines(spark, path).select(F.lit(split).alias("split"), ref.alias("ref"), "line_no", v.alias("v"))


def read_tree(spark: SparkSession, root: str, splits: tuple[str, ...] = SPLITS) -> tuple[DataFrame | None, list[str]]:
    """Raw records of all splits that exist, and the splits that have no file.

    Only files named after a split are read; other files beside them never are.
    """
    parts = {s: read_split(spark, root, s) for s in splits}
    out = None
    for p in parts.values():
        if p is not None:
            out = p if out is None else out.unionByName(p)
    return out, [s for s, p in parts.items() if p is None]


def split_of(key: Column) -> Column:
    """The split by a numeric key: 90, 5 and 5 of a hundred."""
    return F.when(key % 20 == 18, "validation").when(key % 20 == 19, "test").otherwise("train")


def from_turns(turns: DataFrame) -> DataFrame:
    """Dialogues (id, split, category, turns, line_no) from rows of (conv_id, turn, role, text)."""
    by = F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("speaker"), "text")))
    d = turns.groupBy("conv_id").agg(by.alias("t"))
    category = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("conv_id") % len(CATEGORIES) + 1).cast("int"))
    said = F.transform("t", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text")))
    return d.select(F.format_string("conv_%06d", "conv_id").alias("id"), split_of(F.col("conv_id")).alias("split"), category.alias("category"), said.alias("turns"), F.col("conv_id").cast("long").alias("line_no"))


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_turns(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def read_log(spark: SparkSession, path: str, schema: str, placed: bool = False) -> DataFrame:
    """An append log of JSON lines; empty if it doesn't exist, an error if a line is bad.

    ``placed`` adds ``at``, by which lines are in the order in which they were written: by file, and by place in it.
    """
    if not exists(spark, path):
        at = "at struct<written:timestamp,file:string,block:long,line:long>"
        return spark.createDataFrame([], f"{schema}, {at}" if placed else schema)
    log = spark.read.schema(schema).json(path, mode="FAILFAST")
    if not placed:
        return log
    file = [F.col(f"_metadata.{x}").alias(y) for x, y in (("file_modification_time", "written"), ("file_path", "file"), ("file_block_start", "block"))]
    return log.select("*", F.struct(*file, F.monotonically_increasing_id().alias("line")).alias("at"))


def read_documents(spark: SparkSession, paths: str) -> DataFrame:
    """JSON files as (path, v variant); null v: not JSON."""
    raw = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.try_parse_json("value").alias("v"))


def read_ids(spark: SparkSession, root: str, split: str) -> DataFrame:
    """(split, id) of the sound files of a split. Their contents aren't read."""
    folder = f"{root.rstrip('/')}/{split}/audio"
    if not any(n.endswith(".wav") and not n.startswith(".") for n in children(spark, folder)):
        return spark.createDataFrame([], "split string, id string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)
    return files.select(F.lit(split).alias("split"), F.regexp_extract("path", r"([^/]+)\.[^.]*$", 1).alias("id"))


def leftovers(spark: SparkSession, root: str, split: str) -> list[str]:
    """Partly written files: hidden names with a ``.tmp-`` part."""
    return [n for n in children(spark, f"{root.rstrip('/')}/{split}/audio") if n.startswith(".") and ".tmp-" in n]


def hash_files(spark: SparkSession, paths: str) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("sha256"))


def paired(spark: SparkSession, root: str, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """(split, id) of sound files that have a companion JSON, in order."""
    out = spark.createDataFrame([], "split string, id string")
    for s in splits:
        names = [n[:-5] for n in children(spark, f"{root.rstrip('/')}/{s}/audio") if n.endswith(".json")]
        have = spark.createDataFrame([(n,) for n in names], "id string")
        out = out.unionByName(read_ids(spark, root, s).join(have, "id", "left_semi").select("split", "id"))
    return out.orderBy("split", "id")


def environment(spark: SparkSession, packages: tuple[str, ...] = ("pyspark", "numpy", "pandas", "pyarrow")) -> dict[str, str]:
    """Versions for provenance; what can't be found is 'unavailable'."""
    import sys
    from importlib.metadata import PackageNotFoundError, version

    found = {"python": sys.version.split()[0], "spark": spark.version}
    for p in packages:
        try:
            found[p] = version(p)
        except PackageNotFoundError:
            found[p] = "unavailable"
    return found
