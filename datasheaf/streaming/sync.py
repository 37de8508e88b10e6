"""Streaming forms of the incremental operators: new files only, sessions for gaps, windows with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_new_files(spark: SparkSession, path: str, schema, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files that no earlier run has read; state is the query's checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def timestamped(df: DataFrame, column: str) -> DataFrame:
    """A time without zone can't carry a watermark: it is read as UTC."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def sync_new(stream: DataFrame, store: str, key: str, checkpoint: str) -> StreamingQuery:
    """Append what the store lacks, by key, batch by batch (SET-01). A batch that is repeated after a failure adds nothing twice."""

    def batch(df: DataFrame, _: int) -> None:
        spark = df.sparkSession
        fresh = df.dropDuplicates([key])
        try:
            known = spark.read.parquet(store).select(key)
            fresh = fresh.join(known, key, "left_anti")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(store)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(stream: DataFrame, time: str, gap: str, late: str, by: str) -> DataFrame:
    """Gap clusters over a stream (WIN-03): (by, start, end, n) of events no more than ``gap`` apart; events later than ``late`` are dropped."""
    grouped = timestamped(stream, time).withWatermark(time, late).groupBy(by, F.session_window(time, gap))
    return grouped.agg(F.count("*").alias("n")).select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def tumbling(stream: DataFrame, time: str, width: str, late: str, by: str) -> DataFrame:
    """(by, start, n, total of value) in windows of fixed width."""
    grouped = timestamped(stream, time).withWatermark(time, late).groupBy(by, F.window(time, width))
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(by, F.col("window.start").alias("start"), "n", "total")


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append", transform: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run a stream over what is there and return the result table; for tests and reports."""
    out = transform(df) if transform else df
    q = out.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
