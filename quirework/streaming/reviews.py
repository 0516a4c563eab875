"""Review events as a stream: state by key, and an idempotent append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import stored

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(EVENT).option("pathGlobFilter", glob).parquet(path)


def activity(rows: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Events and value by window and type; events later than `late` are dropped by the watermark."""
    rows = rows.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def append_new(rows: DataFrame, path: str, key: list[str], checkpoint: str) -> StreamingQuery:
    """Appends rows whose key the table does not hold; a batch that is replayed adds nothing."""

    def batch(df: DataFrame, _: int) -> None:
        fresh = df.dropDuplicates(key)
        held = stored(df.sparkSession, path, kind="parquet")  # none before the first batch
        if held is not None:
            fresh = fresh.join(held.select(*key), key, "left_anti")
        fresh.write.mode("append").parquet(path)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
