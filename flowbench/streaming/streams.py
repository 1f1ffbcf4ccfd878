"""Structured Streaming: scoring, counters, windowed metrics, gate, de-duplication, k-means.

Every stream is read from a folder of files, run to the end of what is there (``availableNow``) and
written to the shared folder, so that no result passes through the driver. The same functions take a
stream from any other source.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowbench.operators.cluster import kmeans_step
from flowbench.operators.metrics import decision_score
from flowbench.session import scratch_path


def stream_table(spark: SparkSession, folder: str, schema, pattern: str | None = None, per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def run_to_files(stream: DataFrame, label: str) -> DataFrame:
    """Append the stream to parquet files until the source is read, then return the files as a table."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    query = (stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/state")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The batch scoring function on a stream: it must only project and join small tables."""
    return run_to_files(score(stream), "stream-score")


@dataclass
class BatchTable:
    """The table a stream has reached, kept in the shared folder under the number of the batch that wrote it.

    Batches take turns in two slots: a batch reads what was written before it and replaces the older slot. A batch that is run
    again, after a failure or by a restarted driver, so reads the same table and writes the same rows, and no more than two tables
    are kept. ``first`` is the table before any batch.
    """

    spark: SparkSession
    path: str
    schema: str

    def begin(self, first: DataFrame) -> None:
        first.withColumn("batch", F.lit(-1).cast("long")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/slot=2")

    def before(self, batch: int | None = None) -> DataFrame:
        """The last table, or the last one before a batch."""
        kept = self.spark.read.schema(f"{self.schema}, batch long, slot int").parquet(self.path)
        kept = kept if batch is None else kept.filter(F.col("batch") < batch)
        last = kept.agg(F.max("batch")).first()[0]
        # The slot is named, so that files of the one to be replaced are not even listed.
        return kept.filter(F.col("slot") == F.lit(2 if last < 0 else last % 2)).drop("batch", "slot")

    def write(self, table: DataFrame, batch: int) -> None:
        table.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.path}/slot={batch % 2}")


def _run(stream: DataFrame, path: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(each).trigger(availableNow=True).start()
    query.awaitTermination()


def stream_counters(stream: DataFrame, attack: Column, right: Column, path: str | None = None) -> DataFrame:
    """Running totals of flows, attacks and right calls; each batch replaces the one-row table. Give the same ``path`` to go on
    after a restart."""
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-counters")
    totals = stream.agg(F.count(F.lit(1)).alias("flows"), F.count_if(attack).alias("attacks"), F.count_if(right).alias("right"))
    kept = BatchTable(spark, f"{path}/data", "flows long, attacks long, right long")
    kept.begin(spark.createDataFrame([(0, 0, 0)], totals.schema))
    _run(totals, path, kept.write, "complete")
    return kept.before()


def windowed_counts(stream: DataFrame, time: str, blocked: Column, attack: Column, delay: str = "1 hour", window: str = "1 day") -> DataFrame:
    """tp, fp, fn, tn per tumbling window; late rows are dropped by the watermark."""
    timed = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", delay)
    agg = timed.groupBy(F.window("__t", window)).agg(
        F.count_if(blocked & attack).alias("tp"), F.count_if(blocked & ~attack).alias("fp"),
        F.count_if(~blocked & attack).alias("fn"), F.count_if(~blocked & ~attack).alias("tn"))
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "tp", "fp", "fn", "tn")


def stream_window_metrics(stream: DataFrame, time: str, pred: Column, truth: Column, delay: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Confusion counts per period, written when the period is closed."""
    return run_to_files(windowed_counts(stream, time, pred, truth, delay, window), "stream-windows")


def stream_gate(stream: DataFrame, time: str, p: Column, threshold: float, attack: Column, delay: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Block flows with p >= threshold; counts and points per period."""
    out = run_to_files(windowed_counts(stream, time, p >= threshold, attack, delay, window), "stream-gate")
    return out.withColumn("points", decision_score())


def stream_dedup(stream: DataFrame, time: str, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """Rows without copies that arrive within the watermark delay; the state of older keys is dropped."""
    timed = stream.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", delay)
    return run_to_files(timed.dropDuplicatesWithinWatermark(keys).drop("__t"), "stream-dedup")


_CENTERS = "cluster int, center array<double>, weight double"


def learn_centers(kept: BatchTable, vec: str, decay: float, batch: DataFrame, number: int) -> None:
    """One batch of mini-batch k-means: every centre moves toward its rows' mean with their share of all it has seen."""
    old = kept.before(number)
    centers = np.array([r["center"] for r in old.orderBy("cluster").collect()], dtype=np.float64)
    step = kmeans_step(batch, vec, centers).select("cluster", "size", F.col("center").alias("mean"))
    weight = F.col("weight") * decay + F.coalesce("size", F.lit(0))
    moved = F.zip_with("center", "mean", lambda c, m: c + (m - c) * (F.col("size") / weight))
    kept.write(old.join(step, "cluster", "left").select("cluster", F.coalesce(moved, "center").alias("center"), weight.alias("weight")), number)


def stream_kmeans(stream: DataFrame, vec: str, centers: np.ndarray, decay: float = 1.0, path: str | None = None) -> DataFrame:
    """Mini-batch k-means over the stream's batches: (cluster, center, weight); old batches count less when decay < 1.

    The centres are a table in the shared folder (``BatchTable``), not memory of the driver. Give the same ``path`` to go on after a
    restart: batches that were learned are neither lost nor learned twice, and ``centers`` only matter before the first batch.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream-kmeans")
    kept = BatchTable(spark, f"{path}/centers", _CENTERS)
    kept.begin(spark.createDataFrame([(i, [float(x) for x in c], 0.0) for i, c in enumerate(centers)], _CENTERS))
    _run(stream, path, lambda batch, number: learn_centers(kept, vec, decay, batch, number))
    return kept.before()
