"""Sinks for micro-batches. Each write is idempotent, so a replayed batch leaves the same table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide.storage import path_exists, remove_path


#: The partition of rows without a day; days are counted from 1970, and numbers make the broadcast of those touched small.
NO_DAY = -(1 << 31)
#: Touched partitions that are named to the reader one by one.
LISTED = 100


class UpsertTable:
    """A keyed Parquet table, one row per key, kept current by dynamic partition overwrite.

    Partitions are days (of ``day_of``) or buckets of the key. A write merges its rows with the partitions that they touch and
    lets Spark replace just these, so its cost follows the batch and the partitions it touches. Every row carries the batch that wrote it
    and the row it replaced, so a retry of the last batch starts from the rows before its first attempt and leaves the same
    table. The merged rows are stored beside the table before they replace anything; a write that was cut off between is
    finished from there by the next use. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], order: list[str],
        day_of: str | None = None, buckets: int = 16,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.day_of, self.buckets = keys, order, day_of, buckets
        self.stored = T.StructType([
            *schema.fields, T.StructField("_writer", T.StringType()), T.StructField("_batch", T.LongType()),
            T.StructField("_before", schema), T.StructField("_part", T.LongType()),
        ])

    def _part(self) -> Column:
        if self.day_of:
            return F.coalesce(F.unix_date(F.to_date(self.day_of)), F.lit(NO_DAY)).cast("long")
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("long")

    def _rows(self) -> DataFrame:
        self._finish()
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(f"{self.path}/rows")

    def _touched(self, parts: DataFrame) -> DataFrame:
        """The rows of the days or buckets of one batch. Where these are few, no other folder of the table is listed."""
        self._finish()
        root = f"{self.path}/rows"
        if not path_exists(self.spark, root):
            return self.spark.createDataFrame([], self.stored)
        few = [row["_part"] for row in parts.limit(LISTED + 1).collect()]
        if len(few) > LISTED:
            return self._rows().join(F.broadcast(parts), "_part", "left_semi")  # prunes the partitions read
        there = [path for path in (f"{root}/_part={part}" for part in few) if path_exists(self.spark, path)]
        if not there:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).option("basePath", root).parquet(*there)

    def _without(self, rows: DataFrame, writer: str, batch_id: int) -> DataFrame:
        """The rows as they were before a batch."""
        undone = F.coalesce((F.col("_writer") == writer) & (F.col("_batch") == int(batch_id)), F.lit(False))
        before = rows.withColumns({
            "_row": F.when(undone, F.col("_before")).otherwise(F.struct(*self.schema.names)),
            "_writer": F.when(~undone, F.col("_writer")), "_batch": F.when(~undone, F.col("_batch")),
            "_before": F.when(~undone, F.col("_before")),
        })
        return before.filter("_row IS NOT NULL").select("_row.*", "_writer", "_batch", "_before", "_part")

    def upsert(self, rows: DataFrame, batch_id: int, writer: str = "batch") -> None:
        """Merge one row per key of ``rows`` into the table as batch ``batch_id`` of ``writer``."""
        new = rows.select(*self.schema.names).withColumns({
            "_writer": F.lit(writer), "_batch": F.lit(int(batch_id)).cast("long"), "_before": F.lit(None).cast(self.schema),
            "_part": self._part(), "_new": F.lit(1),
        })
        old = self._without(self._touched(new.select("_part").distinct()), writer, batch_id).withColumn("_new", F.lit(0))
        row = F.struct(*self.schema.names, "_writer", "_batch", "_before", "_part", "_new")
        one = F.when(F.col("_new") == 0, F.struct(*self.schema.names))
        merged = (
            old.unionByName(new).groupBy(*[F.col(k).alias(f"_key_{k}") for k in self.keys])
            .agg(F.max_by(row, F.struct(*self.order, "_new")).alias("_row"), F.first(one, ignorenulls=True).alias("_old"))
            .select("_row.*", "_old").withColumn("_before", F.when(F.col("_new") == 1, F.col("_old")).otherwise(F.col("_before")))
        )
        merged.select(*self.stored.names).hint("rebalance", F.col("_part")).write.mode("overwrite").parquet(f"{self.path}/merged")
        self._finish()

    def _finish(self) -> None:
        """Replace the partitions of merged rows that are whole, then drop them; doing so twice is the same."""
        if path_exists(self.spark, f"{self.path}/merged/_SUCCESS"):
            merged = self.spark.read.schema(self.stored).parquet(f"{self.path}/merged")
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(f"{self.path}/rows")
            remove_path(self.spark, f"{self.path}/merged")

    def read(self, without: tuple[str, int] | None = None) -> DataFrame:
        """Current rows; ``without`` gives those before one (writer, batch) if it was the last, which a retry of it needs."""
        rows = self._rows()
        return (self._without(rows, *without) if without else rows).select(*self.schema.names)


class EmptyExportError(ValueError):
    """There is nothing to export."""


def export_features(features: DataFrame, path: str) -> None:
    """Write features partitioned by day.

    Rows are rebalanced by day, so that a small day is one file and a large one is split over tasks. Raises when
    there are no rows.
    """
    if features.isEmpty():
        raise EmptyExportError("the feature table is empty; run the stream first")
    day = F.to_date("window_start")
    (
        features.withColumn("day", day)
        .hint("rebalance", F.col("day"))
        .sortWithinPartitions("day", "store_id", "sku_id", "window_start")
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(path)
    )


DRIFT_REPORT = "feature STRING, psi DOUBLE, ks_stat DOUBLE, ks_pval DOUBLE, js_div DOUBLE, drifted DOUBLE"


def write_drift_report(metrics: DataFrame, path: str) -> None:
    """The drift table as one CSV file; it has one row per monitored feature."""
    columns = ["feature", "psi", "ks_stat", "ks_pval", "js_div", "drifted"]
    metrics.select(*columns).coalesce(1).sortWithinPartitions("feature").write.mode("overwrite").option(
        "header", True
    ).csv(path)


def read_drift_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DRIFT_REPORT).option("header", True).csv(path)


def append_metrics(rows: DataFrame, path: str, run_id: str) -> None:
    """Append one run to the metric log; writing the same run twice keeps one copy."""
    rows.drop("run_id").write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "experiment STRING, start_time TIMESTAMP, metric STRING, value DOUBLE, run_id STRING"
    return spark.read.schema(schema).parquet(path)


def write_topics(messages: DataFrame, servers: str) -> None:
    """Send (topic, value) rows to Kafka; one sink serves all topics. Needs the connector on the class path."""
    messages.selectExpr("topic", "CAST(value AS STRING) AS value").write.format("kafka").option(
        "kafka.bootstrap.servers", servers
    ).save()


def write_jdbc(rows: DataFrame, url: str, table: str, partitions: int = 16, **options: str) -> None:
    """Append rows to a staging table over a bounded number of connections; the database merges from there."""
    rows.coalesce(partitions).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
