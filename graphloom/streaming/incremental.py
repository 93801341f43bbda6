"""Indexing as catalogs arrive, and batches kept ready for a consumer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def index_as_it_arrives(spark: SparkSession, source: str, schema: str, build: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, key: str = "program") -> StreamingQuery:
    """Builds the index of every newly arrived catalog file, and appends it to target partitioned by key.

    Each micro-batch writes a folder of its own number, so a batch that runs again replaces its own rows only.
    """
    def write(batch: DataFrame, number: int) -> None:
        build(batch).withColumn("batch_id", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", key).parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows per window and key; a window closes when the watermark passes it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


class ReadyPool:
    """Batches by configuration, made ahead of use: partitions are fetched while the consumer works on earlier ones."""

    def __init__(self, produce: dict[Any, Callable[[int], DataFrame]], postprocess: Callable[[list], Any] = list):
        self.produce, self.postprocess = produce, postprocess
        self.next = dict.fromkeys(produce, 0)
        self.open: dict[Any, Iterator] = {}

    def get(self, config: Any, size: int) -> Any:
        """The next `size` rows of a configuration, in order; a failed producer raises here."""
        rows: list = []
        while len(rows) < size:
            if config not in self.open:
                self.open[config] = self.produce[config](self.next[config]).toLocalIterator(prefetchPartitions=True)
                self.next[config] += 1
                fresh = True
            else:
                fresh = False
            got = next(self.open[config], None)
            if got is None:
                del self.open[config]
                if fresh:
                    raise RuntimeError(f"no rows for {config}")
                continue
            rows.append(got)
        return self.postprocess(rows)
