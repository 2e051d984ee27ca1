"""Hard negatives by exact integer inner products, multiplied as residues in single precision.

Residue-number-system GEMM: the integer matrices are reduced modulo several small primes to balanced residues, so each
product of two residue matrices is exact in float32, where matrix multiplication is fast. The signed scores come back by the
Chinese remainder theorem in balanced mixed radix, as many primes as the largest possible score needs.

Anchors are a stated query set. They go to the workers in chunks of bounded size; each task multiplies its rows with a
chunk in blocks and keeps the best few rows per anchor (then per anchor and positive, inside the window of scores that
the positive sets). Windows over what the tasks kept select the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stocktide.storage import discard, staged

#: Sums of this many products of balanced residues stay below 2**24 for every prime below ``PRIME_LIMIT``.
WIDTH = 64
PRIME_LIMIT = 1022
#: Anchors in a chunk have at most so many bytes of vectors, 8 a component, and so many rows.
CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 1 << 14
#: Anchors and rows multiplied at a time.
BLOCK_ANCHORS, BLOCK_ROWS = 256, 8192
NONE = np.iinfo(np.int64).min
LARGEST = (1 << 63) - 1


def primes(bound: int) -> list[int]:
    """The largest primes below ``PRIME_LIMIT``, enough of them that their product exceeds ``2 * bound + 1``."""
    found, product, p = [], 1, PRIME_LIMIT
    while product <= 2 * bound + 1:
        p -= 1
        if p < 3:
            raise ValueError("scores are too large")
        if all(p % q for q in range(2, int(p**0.5) + 1)):
            found.append(p)
            product *= p
    return found


def balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues between -(p - 1) / 2 and (p - 1) / 2."""
    half = (p - 1) // 2
    return (x + half) % p - half


class ResidueGemm:
    """Exact ``a @ b.T`` for a fixed integer matrix ``a`` and any ``b`` whose scores stay within ``bound``."""

    def __init__(self, a: np.ndarray, bound: int):
        self.primes = primes(bound)
        self.a = [balanced(a, p).astype(np.float32) for p in self.primes]
        self.columns = [slice(at, at + WIDTH) for at in range(0, a.shape[1], WIDTH)]

    def residues(self, b: np.ndarray) -> list[np.ndarray]:
        return [balanced(b, p).astype(np.float32) for p in self.primes]

    def scores(self, rows: np.ndarray | slice, b: list[np.ndarray]) -> np.ndarray:
        """Signed scores of some rows of ``a`` with ``b`` in residues; digits of the balanced mixed radix, prime by prime."""
        digits: list[np.ndarray] = []
        for i, p in enumerate(self.primes):
            digit = sum((balanced((self.a[i][rows, c] @ b[i][:, c].T).astype(np.int32), p) for c in self.columns), np.int32(0))
            digit = balanced(digit, p)
            for q, lower in zip(self.primes, digits):
                digit = balanced((digit - lower) * np.int32(pow(q, -1, p)), p)
            digits.append(digit)
        total = digits[-1].astype(np.int64)
        for p, digit in zip(self.primes[-2::-1], digits[-2::-1]):
            total = total * p + digit
        return total


def integer_vectors(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector of whole numbers as double) of the rows that take part."""
    of = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * 256).cast("double"))
    finite = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    taken = rows.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{vector}`").isNotNull() & finite)
    return taken.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), of.alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as whole numbers, shorter ones filled up with zeros."""
    found = np.zeros((len(column), width), np.int64)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    found[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths] or [np.zeros(0, int)]).astype(int)] = (
        column.flatten().to_numpy(zero_copy_only=False)
    )
    return found


class Best:
    """Per slot (an anchor, or an anchor with one of its positives), the best few rows so far: higher scores, then smaller ids."""

    def __init__(self, slots: int, n: int):
        self.score = np.full((slots, n), NONE)
        self.key, self.id = np.zeros((slots, n), np.int64), np.full((slots, n), LARGEST)

    def add(self, slots: np.ndarray, score: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
        """``score`` (slots x rows, NONE where a row does not count) is used up; rows are in the order of their ids."""
        n = self.score.shape[1]
        at, best = [], []
        line = np.arange(len(slots))
        for _ in range(min(n, score.shape[1])):
            j = score.argmax(axis=1)  # the first of equals has the smallest id
            at.append(j)
            best.append(score[line, j])
            score[line, j] = NONE
        at, best = np.stack(at, 1), np.stack(best, 1)
        every = [np.concatenate(pair, axis=1) for pair in ((self.score[slots], best), (self.key[slots], key[at]), (self.id[slots], ids[at]))]
        # ~score falls as score rises and cannot overflow
        order = np.lexsort((every[1], every[2], ~every[0]), axis=1)[:, :n]
        for held, values in zip((self.score, self.key, self.id), every):
            held[slots] = np.take_along_axis(values, order, axis=1)

    def found(self) -> tuple[np.ndarray, ...]:
        slot, i = np.nonzero(self.score != NONE)
        return slot, self.score[slot, i], self.key[slot, i], self.id[slot, i]


def _search(rows: DataFrame, anchors, gemm_bound: int, width: int, n: int, windows=None) -> DataFrame:
    """What each task keeps of its rows for a broadcast chunk of anchors (keys, labels, matrix).

    Without ``windows`` the rows of an anchor's own label but itself, else for every slot (anchor, least, most) the rows of other
    labels whose score lies inside.
    """
    kind = T.StructType.fromDDL("slot long, score long, row long, id long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, labels, matrix = anchors.value
        gemm = ResidueGemm(matrix, gemm_bound)
        slots = windows.value if windows is not None else None
        best = Best(len(keys) if slots is None else len(slots[0]), n)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                ids = part.column("id").fill_null(LARGEST).to_numpy(zero_copy_only=False)
                order = np.lexsort((part.column("row").to_numpy(), ids))
                ids, key, label = ids[order], part.column("row").to_numpy()[order], part.column("label").to_numpy()[order]
                b = gemm.residues(_matrix(part.column("vector"), width)[order])
                if slots is None:
                    for one in np.intersect1d(labels, label):
                        mine, theirs = np.flatnonzero(labels == one), np.flatnonzero(label == one)
                        some = [r[theirs] for r in b]
                        for lo in range(0, len(mine), BLOCK_ANCHORS):
                            block = mine[lo:lo + BLOCK_ANCHORS]
                            score = gemm.scores(block, some)
                            score[keys[block][:, None] == key[theirs]] = NONE
                            best.add(block, score, key[theirs], ids[theirs])
                else:
                    for lo in range(0, len(keys), BLOCK_ANCHORS):
                        block = slice(lo, lo + BLOCK_ANCHORS)
                        score = gemm.scores(block, b)
                        score[labels[block][:, None] == label] = NONE
                        first, last = np.searchsorted(slots[0], [lo, lo + BLOCK_ANCHORS])
                        for at_slot in range(first, last, BLOCK_ANCHORS):
                            some = np.arange(at_slot, min(last, at_slot + BLOCK_ANCHORS))
                            mine = score[slots[0][some] - lo]
                            mine[(mine < slots[1][some][:, None]) | (mine > slots[2][some][:, None])] = NONE
                            best.add(some, mine, key, ids)
        slot, score, key, ids = best.found()
        for at in range(0, len(slot), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[cut]), pa.array(score[cut]), pa.array(key[cut]), pa.array(ids[cut], mask=ids[cut] == LARGEST)],
                schema=to_arrow_schema(kind),
            )

    return rows.mapInArrow(run, kind)


def _ranked(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` best of every slot; a slot has at most ``n`` rows of each task."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame, anchor_where: str = "id % 50 = 0", positives: int = 5, negatives: int = 3, share: tuple[int, int] = (50, 95),
    id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels in the positive's window.

    Components become ``floor(256 * x)``; a score is the integer inner product with the anchor. Of two equal scores the smaller id comes
    first (no id last). A negative's score, times 100, lies between the positive's score times each of ``share``. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score. ``anchor_where`` is a condition on id and label.

    Rows with a NULL label, a NULL vector or a component that is NULL or not finite take no part, nor do those with a
    component so large that a score of two such rows might not fit a long. Shorter vectors count as filled up with zeros. Repeated rows
    are rows of their own, also as anchors; a row with a NULL id can be found, but ``id`` conditions make it no anchor. An empty table gives
    an empty result; other columns are ignored.

    Anchors reach the workers in chunks of at most ``CHUNK_ROWS`` rows and ``CHUNK_BYTES``, one scan of all rows for the positives of a
    chunk and one for its negatives, so memory does not grow with the table; every anchor meets every row.
    """
    spark = rows.sparkSession
    taken = integer_vectors(rows, id_column, vector, label)
    whole = staged(taken.withColumn("row", F.monotonically_increasing_id()))
    width = whole.agg(F.max(F.size("vector"))).first()[0] or 1
    limit = int((LARGEST // width) ** 0.5)
    whole = whole.filter(F.forall("vector", lambda x: F.abs(x) <= float(limit)))
    most = whole.agg(F.max(F.array_max(F.transform("vector", lambda x: F.abs(x))))).first()[0]
    bound = width * int(most or 1) ** 2
    asked = whole.filter(anchor_where)
    # chunks by key ranges: counts per partition of the staged rows are few numbers
    chunk = max(1, min(CHUNK_ROWS, CHUNK_BYTES // (8 * width)))
    numbered = staged(asked.select("row", "id", "label", "vector", F.expr("shiftright(row, 33)").alias("part")))
    starts, total = {}, 0
    for r in numbered.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts[r["part"]] = total
        total += r["n"]
    out = None
    if total:
        offset = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
        place = F.row_number().over(Window.partitionBy("part").orderBy("row")) - 1 + offset[F.col("part")]
        placed = staged(numbered.withColumn("chunk", F.floor(place / chunk).cast("int")))
        for c in range(-(-total // chunk)):
            found = _chunk(spark, whole, placed.filter(F.col("chunk") == c), bound, width, positives, negatives, share)
            out = found if out is None else out.unionAll(found)
        discard(placed)
    discard(numbered)
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return out if out is not None else spark.createDataFrame([], kind)


def _chunk(spark, whole, anchors, bound, width, positives, negatives, share) -> DataFrame:
    held = anchors.select("row", "id", "label", "vector").orderBy("row").toArrow().combine_chunks()
    keys, labels = (held.column(c).to_numpy() for c in ("row", "label"))
    matrix = _matrix(held.column("vector").combine_chunks(), width)
    shared = spark.sparkContext.broadcast((keys, labels, matrix))
    found = _ranked(_search(whole, shared, bound, width, positives), positives)
    best = found.select("slot", "rank", "id", "score").orderBy("slot", "rank").toArrow()  # ``positives`` rows an anchor at most
    slot, score = best.column("slot").to_numpy(), best.column("score").to_numpy()
    # whole numbers: share[0] * score <= 100 * negative <= share[1] * score, without products that might overflow
    whole_part, rest = np.divmod(score, 100)
    least = whole_part * share[0] - (-rest * share[0] // 100)
    most = whole_part * share[1] + rest * share[1] // 100
    windows = spark.sparkContext.broadcast((slot, least, most))
    kept = staged(_ranked(_search(whole, shared, bound, width, negatives, windows), negatives))
    names = pa.table({
        "slot": np.arange(len(slot)), "anchor_id": held.column("id").combine_chunks().take(pa.array(slot)),
        "positive_id": best.column("id").combine_chunks(), "positive_score": score,
    })
    kind = "slot long, anchor_id long, positive_id long, positive_score long"
    known = F.broadcast(spark.createDataFrame(names, kind))  # bounded like the chunk
    return kept.join(known, "slot").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    shifted = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(shifted)


OP12_SQL = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS k
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.k AS a, a.vec_id AS anchor_id, b.vec_id, b.k, a.label = b.label AS same,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.k <> b.k
), p AS (
    SELECT a, anchor_id, vec_id AS positive_id, k AS p, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, k) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.vec_id, s.k)
QUALIFY row_number() OVER w <= 3
"""
