"""What the corpus operators share: words, stored intermediate tables, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
#: What drops that which a Python worker remembers from one task to the next.
REMEMBERING: list[Callable[[], None]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; empty for null and for blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one where none is set and all runs on one machine, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="dialoom-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str = "part", files: int = 0, compression: str = "snappy") -> DataFrame:
    """Write a table into the shared folder and read it back, in few files if ``files`` is given.

    This cuts the lineage: a lost executor costs no more than the tasks it ran,
    since what was written doesn't live on it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.coalesce(files) if files else df).write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._dialoom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that no later step reads, and let Spark clear old shuffle files."""
    for df in tables:
        path = getattr(df, "_dialoom_path", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    release(tables[0].sparkSession if tables else None)


def release(spark: SparkSession | None) -> None:
    """Shuffle files of finished steps go once the driver's JVM notices that nothing refers to them."""
    gc.collect()
    trim()
    if spark is not None:
        spark._jvm.System.gc()


def trim() -> None:
    """Give this process's free memory back to the system."""
    pa.default_memory_pool().release_unused()
    trimmed = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries have none
    if trimmed:
        trimmed(0)


def lean(run: Callable[[Iterator], Iterator], forget: bool = True) -> Callable[[Iterator], Iterator]:
    """A function over batches that leaves no free memory with its worker, which stays beside the JVM when the task has ended.

    With ``forget`` the worker first drops what it remembers from tasks of another kind.
    """
    def whole(batches: Iterator) -> Iterator:
        if forget:
            for drop in REMEMBERING:
                drop()
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def salted(left: DataFrame, right: DataFrame, key: str, by: str, salts: int = 8) -> DataFrame:
    """Join on ``key`` with the rows of a key dealt to several tasks by column ``by``; ``right`` has one row a key."""
    l = left.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    return l.join(right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), [key, "salt"]).drop("salt")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows ``(node, component)``.

    Alternating large and small stars, each a map-side combined minimum and a salted
    equi-join, so a node with very many neighbours isn't one task. The component is
    its smallest node. Nodes without an edge are not listed. Empty edges give an empty table.
    """
    e = stored(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = salted(both.where("b > a"), least, "a", "b").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        least2 = large.groupBy("b").agg(F.min("a").alias("m"))
        small = salted(large, least2, "b", "a")
        nxt = stored(small.select(F.col("m").alias("x"), F.col("b").alias("y")).unionByName(small.select(F.col("m").alias("x"), F.col("a").alias("y"))).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        now = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        discard(e)
        e = nxt
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
