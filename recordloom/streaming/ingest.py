"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_new_files(spark: SparkSession, path: str, schema: StructType, *, per_trigger: int = 100) -> DataFrame:
    """Each file of a folder once, as it appears; the checkpoint holds which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed_counts(events: DataFrame, *, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events by type and window; rows later than the watermark are left out, as the window is closed."""
    return events.withWatermark("at", late).groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def append_once(stream: DataFrame, path: str, checkpoint: str, key: list[str]) -> StreamingQuery:
    """Appends the rows of keys that no earlier batch has written, one of each; a batch that runs again writes its own folder anew, so nothing doubles.

    The keys written before are anti-joined, so each batch reads the key columns of the
    table; null keys are never taken for the same. The watermarked
    ``dropDuplicatesWithinWatermark`` suits streams whose repeats come soon.
    """

    def write(batch: DataFrame, number: int) -> None:
        fresh, spark = batch.dropDuplicates(key), batch.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if number and at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            written = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in batch.schema)}, batch long").parquet(path)
            fresh = fresh.join(written.where(F.col("batch") < number).select(*key), key, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
