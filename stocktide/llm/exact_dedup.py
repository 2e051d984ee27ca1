"""Exact dedup by two passes over a Bloom filter, with DataFrame functions only.

Pass one reduces every text to its digest and sets two bits per digest in a bitmap, then keeps the bits that more than
one row sets. Pass two looks each digest up: a row with a bit that nobody else sets is certainly the only one of its
text and passes straight through. Only rows whose two bits are shared are shuffled by their digest and compared.
The bitmap has at least 16 bits a row up to ``max_bits``, so what is broadcast is bounded (128 MB at the default).
Beyond that more single rows take the shuffle; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.hot import MAX_BITS, bitmaps_of, bits_for, slots, spread_join, with_maybe
from stocktide.llm.worker import renamed
from stocktide.storage import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; NULL counts as the empty text."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), 256))


def shared_bits(keyed: DataFrame, bits: int) -> DataFrame:
    """The bits that more than one row sets, as bitmaps by bucket. Shuffles bit numbers, counted per task first."""
    set_ = keyed.select(F.explode(F.array_distinct(F.array(*slots(F.col("sha"), bits)))).alias("slot"))
    return bitmaps_of(set_.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))


class _Repeats:
    """Bitmaps and repeated digests of a table of (doc_id, sha)."""

    def __init__(self, keyed: DataFrame, max_bits: int):
        self.rows = keyed.count()
        self.bits = bits_for(self.rows, max_bits)
        self.bitmaps = staged(shared_bits(keyed, self.bits))
        # Rows of one id and text are counted first, so that a winner that stands there twice is known.
        self.groups = staged(
            self.marked(keyed).filter("maybe")
            .groupBy("sha", "doc_id").agg(F.count(F.lit(1)).alias("same"))
            .groupBy("sha").agg(F.max(F.struct("doc_id", "same")).alias("last"), F.sum("same").alias("group_size"))
            .filter("group_size > 1")
            .select("sha", F.col("last.doc_id").alias("keep_id"), F.col("last.same").alias("same"), "group_size")
        )

    def marked(self, rows: DataFrame) -> DataFrame:
        return with_maybe(rows, "sha", self.bitmaps, self.bits)

    def decided(self, rows: DataFrame) -> DataFrame:
        """Add keep_id, same, group_size to rows with ``sha``; NULL where the text is the only one of its kind."""
        marked, nothing = self.marked(rows), self.groups.drop("sha").schema
        single = marked.filter(~F.col("maybe")).withColumns({f.name: F.lit(None).cast(f.dataType) for f in nothing})
        names = rows.columns + nothing.names
        compared = spread_join(marked.filter("maybe").drop("maybe"), self.groups, "sha", "group_size", self.rows)
        return single.select(names).unionAll(compared.select(names))


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; NULL counts as the empty text. The row with the largest id
    stays; a NULL id is smaller than any other. Rows that repeat the winning id with the same text are one document
    and are all marked as kept (``without_copies`` returns it once). An empty table gives an empty result; other
    columns are ignored.
    """
    keyed = staged(renamed(docs, doc_id=id_column, text=text_column).select("doc_id", digest(F.col("text")).alias("sha")))
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return _Repeats(keyed, max_bits).decided(keyed).select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows that stay, all columns. Rows without a copy are never shuffled. Definitions as in ``exact_dedup``."""
    keyed = staged(renamed(docs, doc_id=id_column, text=text_column).select("doc_id", digest(F.col("text")).alias("sha")))
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_column}`").alias("doc_id"), digest(F.col(f"`{text_column}`")).alias("sha"),
    )
    decided = _Repeats(keyed, max_bits).decided(whole)
    stays = decided.filter(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")))
    once = F.coalesce("same", F.lit(1)) == 1
    # of rows that repeat id and text the one with the smallest hash of all columns, whatever the order they come in
    repeated = stays.filter(~once).groupBy("sha").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return stays.filter(once).select("row.*").unionAll(repeated.select("row.*"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(x) AS text_sha256
FROM t WINDOW g AS (PARTITION BY x)
"""
