"""Canonical exact digests of documents."""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from dialoom.llm.common import discard, stored

#: Slots of the bitmap of repeated digests; it is broadcast, so this bounds it: 2 ** 22 bits are 512 KB.
SLOTS = 1 << 22
#: Documents a range of ids should hold, when they are dealt out to see their neighbours, and the most ranges.
RANGE_ROWS, MOST_RANGES = 500, 20_000


def canonical(text: str | None) -> bytes:
    """Unicode compatibility form, case folded, white space runs as one space, trimmed."""
    t = text or ""
    if not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)
    t = t.casefold()
    if not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)  # folding may leave the form
    return " ".join(t.split()).encode("utf-8", "surrogatepass")


def digest(canon: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(canon, seed=0)


def slot(d: str) -> int:
    return int(d[:8], 16) % SLOTS


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the digest of its canonical text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([digest(canonical(t.as_py())) for t in b.column(1)], pa.string())], names=["doc_id", "digest"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, digest string")


def repeated(found: DataFrame) -> bytes:
    """A bitmap of the slots of digests that occur more than once: SLOTS bits, whatever the input."""
    s = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(SLOTS))
    twice = found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(s.alias("s"))
    words = twice.groupBy(F.shiftright("s", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s % 32 as int))")).alias("v"))
    bits = bytearray(SLOTS // 8)
    for r in words.collect():  # at most SLOTS / 32 rows of two numbers
        bits[r.w * 4 : r.w * 4 + 4] = r.v.to_bytes(4, "little")
    return bytes(bits)


def same_bytes(texts: DataFrame) -> DataFrame:
    """Compare canonical texts byte by byte inside equal buckets: the digests that hold different ones.

    ``texts(digest, canon)``. The least and the greatest text of a bucket are equal
    only if all are. Both are found in each task before the shuffle, so a bucket
    with a third of all rows sends two texts from each task.
    """
    return texts.groupBy("digest").agg(F.min("canon").alias("low"), F.max("canon").alias("high")).where("low <> high").select("digest")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts.

    The edited text has the last third (rounded down) of the code points replaced by
    as many, or all, of the next document's, by descending doc_id; after the last
    document comes the first. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, the likenesses of an exact digest: 1
    for equal canonical bytes, else 0.

    A null text is empty. Rows of one doc_id follow each other by descending text; null
    ids come last. A single document is its own next one. An empty table gives an
    empty one. Texts are dealt out once, in ranges of ids; the first document of a
    range is sent to the range before it too, so each finds its next one beside it.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = stored(digests(d), "digests", compression="zstd")
    bitmap = spark.sparkContext.broadcast(repeated(found))
    cuts = spark.sparkContext.broadcast(range_cuts(found))

    @F.pandas_udf("int")
    def of_id(ids: pd.Series) -> pd.Series:
        # Ranges count from the greatest ids, so the next document lies in the same range or the next one.
        return pd.Series((len(cuts.value) - np.searchsorted(cuts.value, ids.to_numpy(np.int64), side="left")).astype(np.int32))

    def place(doc_id: str) -> Column:
        # Nulls don't reach the function: a batch with one would arrive as doubles, which great ids don't survive.
        return F.when(F.col(doc_id).isNull(), F.lit(len(cuts.value) + 1)).otherwise(of_id(F.coalesce(F.col(doc_id), F.lit(0).cast("long"))))

    heads = found.select("doc_id", place("doc_id").alias("range")).groupBy("range").agg(F.max("doc_id").alias("head")).orderBy("range").collect()  # one row a range
    # The head of each range visits the range before it, the first head the last range.
    guests = spark.createDataFrame([(h.head, heads[k - 1].range) for k, h in enumerate(heads)], "head long, to int")
    visiting = d.join(F.broadcast(guests), d.doc_id.eqNullSafe(F.col("head"))).select("doc_id", "text", F.col("to").alias("range"), F.lit(True).alias("guest"))
    dealt = d.select("doc_id", "text", place("doc_id").alias("range"), F.lit(False).alias("guest")).unionByName(visiting)
    dealt = dealt.repartition("range").sortWithinPartitions("range", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc())

    def edited(row, nxt: str) -> tuple:
        doc_id, text = row
        k = len(text) // 3
        e = text[: len(text) - k] + nxt[:k]
        c, ce, cn = canonical(text), canonical(e), canonical(nxt)
        dg = digest(c)
        de = digest(ce)
        check, check_e = (x if bitmap.value[s >> 3] >> (s & 7) & 1 else None for x, s in ((c, slot(dg)), (hashlib.sha256(ce).hexdigest(), slot(de))))
        return (doc_id, len(text), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), dg, de, float(c == ce), float(c == cn), check, check_e)

    fields = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("canon", pa.binary()), ("edited_canon", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one
        for b in batches:
            out = []
            for i in range(b.num_rows):
                doc_id, text, of, guest = (b.column(k)[i].as_py() for k in range(4))
                if held is not None:  # a range ends with its guest, so this is of the same range
                    out.append(edited(held, text))
                held = None if guest else (doc_id, text)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)] if out else [pa.array([], f.type) for f in fields], schema=fields)

    out = stored(dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, canon binary, edited_canon string"), "fingerprints", compression="zstd")
    clash = same_bytes(out.where("canon IS NOT NULL").select(F.col("fingerprint").alias("digest"), "canon"))
    # Different texts of one digest (none are known) are told apart by a second, longer digest.
    clashing = stored(clash, "clashes")
    out = out.join(clashing, out.fingerprint == clashing.digest, "left")
    again = clashing.select(F.col("digest").alias("edited_digest"))
    out = out.join(again, out.edited_fingerprint == again.edited_digest, "left")
    discard(found)
    own = F.when(F.col("digest").isNotNull(), F.concat("fingerprint", F.lit("-"), F.sha2("canon", 256))).otherwise(F.col("fingerprint"))
    edited_own = F.when(F.col("edited_digest").isNotNull(), F.concat("edited_fingerprint", F.lit("-"), "edited_canon")).otherwise(F.col("edited_fingerprint"))
    return out.select("doc_id", "n_chars", "edited_sha256", own.alias("fingerprint"), edited_own.alias("edited_fingerprint"), "near_edited", "near_next")


def range_cuts(found: DataFrame) -> np.ndarray:
    """Ids that part the documents into ranges of about RANGE_ROWS rows: at most MOST_RANGES numbers.

    From a quantile sketch; the cuts needn't be exact.
    """
    many = min(found.count() // RANGE_ROWS, MOST_RANGES)
    at = [k / (many + 1) for k in range(1, many + 1)]
    return np.array(sorted({int(c) for c in found.approxQuantile("doc_id", at, 0.2 / (many + 1))} if many else []), np.int64)
