"""Batch scans. Schemas are declared; an empty or missing input is an error where the job cannot go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktide import schemas
from stocktide.operators.features import with_parsed_start
from stocktide.storage import path_exists


class NoFeaturesError(FileNotFoundError):
    """The feature history has no rows to work on."""


def _checked(df: DataFrame, rules: dict[str, str], what: str) -> DataFrame:
    """Raise when a row breaks a rule. The rules are a filter, which column pruning cannot take away."""
    for column, rule in rules.items():
        got = F.coalesce(F.col(column).cast("string"), F.lit("NULL"))
        broken = F.raise_error(F.concat(F.lit(f"{what}.{column} must satisfy {rule}, got "), got)).cast("boolean")
        df = df.filter(F.when(F.expr(rule), F.lit(True)).otherwise(broken))
    return df


def dim_sku(spark: SparkSession, path: str) -> DataFrame:
    """Product dimension from CSV with a header; price and reorder point may not be negative."""
    raw = spark.read.schema(schemas.DIM_SKU).option("header", True).option("mode", "FAILFAST").csv(path)
    return _checked(raw, {"unit_price": "unit_price >= 0", "reorder_point": "reorder_point >= 0"}, "dim_sku")


def dim_store(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schemas.DIM_STORE).option("header", True).option("mode", "FAILFAST").csv(path)
    return _checked(raw, {"capacity": "capacity >= 0"}, "dim_store")


def seed_summary(skus: DataFrame, stores: DataFrame) -> DataFrame:
    """One row: products, categories, stores."""
    return skus.agg(F.count("*").alias("n_skus"), F.countDistinct("category").alias("n_categories")).withColumn(
        "n_stores", stores.agg(F.count("*")).scalar()
    )


def feature_history(spark: SparkSession, path: str, schema: T.StructType = schemas.WINDOWED_FEATURES) -> DataFrame:
    """All Parquet files below ``path``, columns matched by name; no file is an error."""
    if not path_exists(spark, path):
        raise NoFeaturesError(f"no feature files below {path}")
    df = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    if not df.inputFiles():
        raise NoFeaturesError(f"no feature files below {path}")
    return with_parsed_start(df)


def feature_availability(features: DataFrame, part: str | None = None) -> DataFrame:
    """One row: files and rows of a feature scan; ``part`` is a pattern whose match in the path stands for the file.

    Rows are counted per file first, so the paths are not shuffled row by row.
    """
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, part, 0) if part else path
    per_file = features.select(name.alias("_f")).groupBy("_f").agg(F.count("*").alias("_n"))
    return per_file.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"))


def features_ordered(features: DataFrame) -> DataFrame:
    """The table by write time. A range-partitioned sort; no task sees the whole table."""
    return features.orderBy("updated_at", *schemas.FEATURE_KEY)


def anomaly_labels(spark: SparkSession, path: str) -> DataFrame:
    """Ground-truth labels from JSON lines; blank lines are skipped, a missing file is an empty frame."""
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], schemas.ANOMALY_LABEL)
    else:
        empty = spark.read.schema(schemas.ANOMALY_LABEL).json(path)
    return empty.withColumn("injected_at", F.try_to_timestamp("injected_at"))


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str, lower: str, upper: str, parts: int) -> DataFrame:
    """A database table read in ``parts`` ranges of ``partition_column``, so that no single task reads it all."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column, lowerBound=lower, upperBound=upper,
                 numPartitions=parts)
        .load()
    )
