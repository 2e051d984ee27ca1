"""Joins that spare the bulk of the rows: hot groups stay where they are, and Bloom filters let the others pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.storage import staged

#: A group with more than this share of all rows is hot; there are fewer such groups than its inverse.
HOT_SHARE = 1e-3
#: Bits of a Bloom filter at most: 128 MB are broadcast then.
MAX_BITS = 1 << 30


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``groups``, which has one row per ``key`` and the number of its rows in ``size``.

    Hot groups are few by their definition, so they are broadcast and their rows stay where they are; no other
    key has many rows, so the rest is shuffled by the key. ``size`` is NULL where a key is missing; a NULL key matches none.
    """
    least = max(1000, int(total * HOT_SHARE))
    hot, cold = groups.filter(F.col(size) > least), groups.filter(F.col(size) <= least)
    added = [c for c in groups.columns if c != key]
    seen = rows.join(F.broadcast(hot), key, "left")
    rest = seen.filter(F.col(size).isNull()).drop(*added).join(cold, key, "left")
    names = rows.columns + added
    return seen.filter(F.col(size).isNotNull()).select(names).unionAll(rest.select(names))


def bits_for(rows: int, max_bits: int = MAX_BITS) -> int:
    """At least 16 bits a row, up to ``max_bits``; beyond that the filter lets more rows through, with the same results."""
    bits = 1 << 15
    while bits < min(16 * rows, max_bits):
        bits *= 2
    return bits


def slots(key: Column, bits: int) -> list[Column]:
    """The two bits of a key."""
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def bitmaps_of(slot: DataFrame) -> DataFrame:
    """Bitmaps by bucket with the bits in the column ``slot`` set."""
    return slot.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bitmap")
    )


def with_maybe(rows: DataFrame, key: str, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Add ``maybe``: whether both bits of the row's key are set. Map-side: the bitmaps are broadcast."""
    tests = []
    for i, slot in enumerate(slots(F.col(key), bits)):
        at = F.expr(f"bitmap_bit_position(slot{i})")
        rows = rows.withColumn(f"slot{i}", slot).join(
            F.broadcast(bitmaps.select(F.col("bucket").alias(f"bucket{i}"), F.col("bitmap").alias(f"bitmap{i}"))),
            F.expr(f"bitmap_bucket_number(slot{i})") == F.col(f"bucket{i}"), "left",
        )
        byte = F.conv(F.hex(F.substring(F.col(f"bitmap{i}"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)))
    return rows.withColumn("maybe", tests[0] & tests[1]).drop(
        *[f"{name}{i}" for name in ("slot", "bucket", "bitmap") for i in (0, 1)]
    )


def apart_by(rows: DataFrame, listed: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` is listed, with the other columns of ``listed``, and rows whose key is not.

    ``listed`` is stored and has one row per key. Only rows that a Bloom filter over the listed keys lets through are
    shuffled, with all they carry; the others pass.
    """
    bits = bits_for(listed.count(), max_bits)
    bitmaps = staged(bitmaps_of(listed.select(F.explode(F.array(*slots(F.col("key"), bits))).alias("slot"))))
    marked = with_maybe(rows, "key", bitmaps, bits)
    added = [c for c in listed.columns if c != "key"]
    known = listed.select(F.col("key").alias("listed_key"), *added)
    checked = marked.filter("maybe").join(known, F.col("key").eqNullSafe(F.col("listed_key")), "left")
    hit = checked.filter(F.col(added[0]).isNotNull()).select(*rows.columns, *added)
    missed = checked.filter(F.col(added[0]).isNull()).select(*rows.columns)
    return hit, marked.filter("NOT maybe").select(*rows.columns).unionAll(missed)


def apart(docs: DataFrame, key: str | Column, listed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Without the rows whose key (a column's name or an expression) is listed (key, stays); where ``stays`` holds, one row
    of that key is left, that of the smallest hash of all columns."""
    key = F.col(f"`{key}`") if isinstance(key, str) else key
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    hit, rest = apart_by(whole, listed, max_bits)
    one = hit.filter("stays").groupBy("key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return rest.select("row.*").unionAll(one.select("row.*"))
