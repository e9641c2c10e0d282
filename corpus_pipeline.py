"""A corpus from raw documents to token ids: clean, drop near copies, cut repeats, mix, encode."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from dialoom.llm.common import shared_dir
from dialoom.llm.mixing import mix
from dialoom.llm.pieces import encode
from dialoom.llm.quality import quality
from dialoom.llm.queries import MODEL
from dialoom.llm.simhash import similar_texts, text_node
from dialoom.llm.suffixes import remove_repeats

REST = ("lang", "source")


def _documents(df: DataFrame, text: str) -> DataFrame:
    """The columns of documents with another text; n_chars is its length."""
    return df.select("doc_id", F.col(text).alias("text"), *REST, F.length(text).cast("long").alias("n_chars"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail the base thresholds or lose too much text go whole."""
    return _documents(quality(docs, keep=REST).where("kept"), "clean_text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the smallest id; of its repeated rows, the least.

    Near copies share at least 0.8 of their five-word shingles: SimHash indexes propose them, an exact check
    decides, and what is too far apart for SimHash is sought by shared shingles. Texts of one id that aren't linked
    all stay, and so do documents without an id.
    """
    named = docs.where("doc_id IS NOT NULL")
    of = similar_texts(named, 5, 0.8)
    node = text_node(F.col("text"))
    ids = named.select("doc_id", node.alias("node")).join(of, "node", "left")
    keep = ids.groupBy(F.coalesce("component", "node").alias("group")).agg(F.min(F.struct("doc_id", "node")).alias("kept")).select("kept")
    both = named.join(keep, F.struct(F.col("doc_id"), node.alias("node")) == F.col("kept"), "left_semi")
    both = both.groupBy("doc_id", node.alias("node")).agg(F.min(F.struct(*docs.columns)).alias("least")).select("least.*")
    return both.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat earlier text go; documents of which nothing is left go."""
    return _documents(remove_repeats(docs, keep=REST), "kept_text").where("n_chars > 0")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: no row for none, several for copies."""
    mixed = mix(docs, keep=("text", "lang", "n_chars")).where("copies > 0")
    return mixed.select("doc_id", "text", "lang", "source", "n_chars", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    return encode(docs, MODEL, keep=("source",))


STAGES = [
    ("quality rules", clean),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", cut_repeats),
    ("mixing sources", mix_sources),
    ("sentencepiece encoding", to_ids),
]

#: SimHash links, suffix order and piece merges aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = f"{shared_dir(spark)}/stage-{k}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
