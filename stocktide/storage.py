"""Where intermediate tables go: the shared folder the session names, never a machine-local one on a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset on a local master."""
    app = spark.sparkContext.applicationId
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = _local.setdefault(app, tempfile.mkdtemp(prefix="stocktide-"))
    return f"{path.rstrip('/')}/stocktide-{app}"


def _located(spark: SparkSession, path: str):
    """The file system that the path names, and the path on it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on the file system that the path names."""
    fs, hadoop_path = _located(spark, path)
    return fs.exists(hadoop_path)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, hadoop_path = _located(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file as a whole."""
    fs, hadoop_path = _located(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small ASCII file that is there as a whole or not at all: written beside its place, then renamed."""
    fs, hadoop_path = _located(spark, path)
    _, beside = _located(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside)
    stream.writeBytes(text)
    stream.close()
    if not fs.rename(beside, hadoop_path):
        raise FileExistsError(path)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _located(spark, path)
    fs.delete(hadoop_path, True)


def staged(df: DataFrame) -> DataFrame:
    """Write an intermediate result that a query reads more than once, and read it back.

    The table lies below the session's shared folder, so a lost executor costs a re-read, not a recomputation,
    and later readers scan only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Remove the tables behind staged frames that nothing reads any more; what was made from them must be stored."""
    for frame in frames:
        path = getattr(frame, "_staged_at", None)
        if path:
            remove_path(frame.sparkSession, path)


def written(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once and read back; lineage is cut by the table, so lost executors re-read instead of recompute.

    The ``_SUCCESS`` marker of the committer decides whether an earlier write finished.
    """
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
