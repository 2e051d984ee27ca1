"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.storage import staged

# Largest look-up table that is broadcast, in rows and in bytes, measured before the join is planned.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# Tasks over which rows without a key are spread; they match nothing wherever they are.
NULL_SALTS = 1 << 16
# Rows of one key that a single task may get.
HOT_ROWS = 1_000_000
# Tasks per key where hot keys cannot be counted.
STREAM_SALTS = 32
_SALT = "_salt"


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with many rows and the number of tasks, ``_salts``, to spread each over.

    A key is hot above ``hot_rows`` rows and above 1 / ``BROADCAST_ROWS`` of all rows, so fewer than ``BROADCAST_ROWS``
    keys are hot, and any other holds too small a share to weigh. Rows with a NULL in the key are not counted.
    """
    counts = staged(
        df.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    )
    share = counts.agg(F.sum("_n")).first()[0] or 0
    limit = max(hot_rows, share // BROADCAST_ROWS)
    return counts.filter(F.col("_n") > limit).select(*on, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))


def salted_join(
    df: DataFrame, table: DataFrame, on: list[str], salt_by: list[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Equi-join in which every hot key of ``df`` is spread over as many tasks as its rows need.

    Rows of a hot key get a salt from a hash of ``salt_by``; ``table`` holds that key once per salt. Rows with a NULL in
    the key are salted as well. Other keys are joined as they are. The salt also keeps Spark from reusing the join's partitioning for a later
    grouping on ``on``, which would gather a hot key again.
    """
    if df.isStreaming:
        return _evenly_salted(df, table, on, salt_by, how)
    hot = hot_keys(df, on, hot_rows)
    spread = F.coalesce(F.col("_salts"), F.lit(1))
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    salted = df.join(F.broadcast(hot), on, "left").withColumn(
        _SALT, F.pmod(F.xxhash64(*salt_by), F.when(keyless, F.lit(NULL_SALTS)).otherwise(spread)).cast("int")
    )
    copies = table.join(F.broadcast(hot), on, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), spread - 1))
    )
    return salted.drop("_salts").join(copies.drop("_salts"), [*on, _SALT], how).drop(_SALT)


def _evenly_salted(df: DataFrame, table: DataFrame, on: list[str], salt_by: list[str], how: str) -> DataFrame:
    """All keys salted alike, for streams, whose hot keys cannot be counted ahead."""
    copies = table.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))))
    salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*salt_by), F.lit(STREAM_SALTS)).cast("int"))
    return salted.join(copies, [*on, _SALT], how).drop(_SALT)


def _fits(table: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows, and ``BROADCAST_BYTES`` bytes counting texts at their length."""
    wide = [f.name for f in table.schema.fields if f.dataType.typeName() in ("string", "binary")]
    text = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c in wide), F.lit(16 * len(table.columns)))
    found = table.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("bytes")).first()
    return found["n"] <= rows and found["bytes"] <= BROADCAST_BYTES


def _broadcast_join(df: DataFrame, table: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join (inner, left) with a broadcast table, matched by a 64-bit hash of the key; the keys are then compared.

    A table by one whole number starts with 1 MB, one by any other key with a page of up to 64 MB, on the driver and on every
    executor, however few rows it has. The comparison is two inequalities, as an equality would become the table's key again.
    """
    left, right = df.schema, table.schema
    if any(left[c].dataType != right[c].dataType for c in on):
        return df.join(F.broadcast(table), on, how)
    rest = [c for c in table.columns if c not in on]
    keyed = table.select(F.xxhash64(*on).alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in on], *rest)
    pairs = [(F.col(c) <= F.col(f"_of_{c}")) & (F.col(c) >= F.col(f"_of_{c}")) for c in on]
    same = reduce(lambda a, b: a & b, pairs, F.col("_hash") == F.col("_of"))
    joined = df.withColumn("_hash", F.xxhash64(*on)).join(F.broadcast(keyed), same, how)
    return joined.select(*on, *[c for c in df.columns if c not in on], *rest)


def lookup_join(
    df: DataFrame, table: DataFrame, on: list[str], salt_by: list[str], how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS, sized_by: DataFrame | None = None,
) -> DataFrame:
    """Join a dimension: broadcast when it is measured to have at most ``broadcast_rows`` rows and ``BROADCAST_BYTES``
    bytes, salted beyond.

    ``sized_by`` is measured in place of ``table`` where that is an aggregate or a distinct of it, which would
    have to be computed to be measured; the measure of a scan stops one row after the limit.
    """
    if _fits(table if sized_by is None else sized_by, broadcast_rows):
        return _broadcast_join(df, table, on, how)
    return salted_join(df, table, on, salt_by, how, hot_rows)
