"""Receipts as a stream: an append log kept compacted, each batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from dialoom.operators.incremental import latest
from dialoom.sources.dialogues import exists
from dialoom.sources.sinks import replace


def read(spark: SparkSession, path: str, schema: str, form: str = "json", files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)


def compact(log: DataFrame, table: str, checkpoint: str, key: str = "id", order: str = "seq") -> StreamingQuery:
    """Keep ``table`` at the last receipt of each key.

    A batch is merged with the table and swapped in whole. A batch that is run again after a
    failure merges rows that are there already, which changes nothing.
    """
    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        both = spark.read.parquet(table).unionByName(batch) if exists(spark, table) else batch
        replace(latest(both, key, order).select(*batch.columns), table)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def throughput(events: DataFrame, time: str, lateness: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Finished and failed records by window of time, for streams with a watermark and for tables."""
    src = events.withWatermark(time, lateness) if events.isStreaming else events
    return src.groupBy(F.window(time, width).alias("w")).agg(F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("failed")).select(F.col("w.start").alias("start"), "completed", "failed")


def progress(done: DataFrame, total: int) -> DataFrame:
    """One row: completed, failed, records a minute and the seconds left (infinite without a rate).

    ``done(ok, started, finished)``: epoch seconds.
    """
    g = done.agg(F.count_if("ok").alias("completed"), F.count_if(~F.col("ok")).alias("failed"), (F.max("finished") - F.min("started")).alias("elapsed"))
    rate = F.when(F.col("elapsed") > 0, (F.col("completed") + F.col("failed")) / F.col("elapsed")).otherwise(F.lit(0.0))
    left = F.greatest(F.lit(total) - F.col("completed") - F.col("failed"), F.lit(0))
    return g.select("completed", "failed", F.coalesce("elapsed", F.lit(0.0)).alias("elapsed_seconds"), (rate * 60).alias("per_minute"), F.when(rate > 0, left / rate).otherwise(F.lit(float("inf"))).alias("eta_seconds"))
