"""Event streams as a ``value`` text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_events(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str) -> DataFrame:
    """A topic's values as text. Needs the Kafka connector on the class path.

    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch and ``minPartitions`` to read a hot partition in slices.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def file_events(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of the files that arrive in a folder, the same shape as a topic."""
    return spark.readStream.schema("value STRING").option("maxFilesPerTrigger", max_files).text(path)


def file_events_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value STRING").text(path)
