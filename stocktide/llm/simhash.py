"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints of 64 bits link at 3 or fewer differing bits. Bits are dealt into ``m`` parts, correlated ones together, and
part i gets a threshold T_i of its own. If the thresholds sum to 3 - m + 1, two linked fingerprints differ in at most T_i
bits in some part. Part sizes are fixed by ``m``; the thresholds (and m) come from dynamic programming over the
expected number of keys and of candidates, estimated from bit statistics of all fingerprints.

A part with threshold 0 is a key as it is; with 1 or 2, a fingerprint gives its own value and all values one bit away, so two
fingerprints up to two bits apart share a key. Fingerprints that share a key are verified. A key with too many of them is
split by applying the principle again to the bits outside the key. Only distinct fingerprints are compared, and each task
hands on a spanning forest of the links that it finds, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.components import components
from stocktide.llm.hot import apart, spread_join
from stocktide.llm.worker import map_rows, release, renamed
from stocktide.storage import staged

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Fingerprints that one key may have before it is split; what is compared in one task at a time.
LARGEST_KEY = 1 << 13
#: Hashes held at a time while a long text's bits are counted.
BLOCK = 1 << 16
ONE = np.uint64(1)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles, repeats included; a text with fewer words is one shingle; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, stops[:-1] + 1)[: len(words) - size + 1].tolist()
    stops = stops[size - 1:].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), BLOCK):
        parts = [joined[a:b] for a, b in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])]
        h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), "<u8", len(parts))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long), one row per input row, without a shuffle."""
    kind = docs.schema[id_column].dataType.simpleString()
    return map_rows(
        renamed(docs, doc_id=id_column, text=text_column), ["doc_id", "text"], f"doc_id {kind}, fp long",
        lambda: lambda ids, texts: (ids, [fingerprint(t) for t in texts]),
    )


# Statistics and plan


def bit_counts(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j both set; 64 x 64 sums over all of them, one matrix per task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS + 1, BITS), np.int64)
        for batch in batches:
            x = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total[:BITS] += (bits.T @ bits).round().astype(np.int64)
            total[BITS, 0] += len(bits)
        place = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "n"])
        release()

    sums = fps.select("fp").mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros((BITS + 1) * BITS, np.int64)
    for r in sums.toLocalIterator():
        out[r["place"]] = r["n"]
    return out.reshape(BITS + 1, BITS)


def grouped_bits(counts: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size: each group grows by the bit most correlated with those it has."""
    n = max(1, int(counts[BITS, 0]))
    p = np.diag(counts[:BITS]) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    like = np.abs((counts[:BITS] / n - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = set(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        group = [min(left, key=lambda b: (spread[b], b))]
        left.remove(group[0])
        while len(group) < size:
            best = max(left, key=lambda b: (like[b, group].mean(), -b))
            group.append(best)
            left.remove(best)
        groups.append(group)
    return groups


def differing(counts: np.ndarray, group: list[int], most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most 0, 1, ... ``most`` bits of a group, as a chain of bit pairs."""
    n = max(1, int(counts[BITS, 0]))
    set_ = np.diag(counts[:BITS]) / n
    p = set_[group[0]]
    state = np.zeros((2, most + 2))  # by whether the last bit differs, and how many have
    state[0, 0], state[1, 1] = p**2 + (1 - p) ** 2, 2 * p * (1 - p)
    for a, b in zip(group, group[1:]):
        p11 = counts[a, b] / n
        p10, p01 = set_[a] - p11, set_[b] - p11
        p00 = max(0.0, 1 - p11 - p10 - p01)
        same_a = [p00**2 + p01**2 + p10**2 + p11**2, 2 * (p00 * p01 + p10 * p11)]
        other_a = [2 * (p00 * p10 + p01 * p11), 2 * (p00 * p11 + p01 * p10)]
        after = np.zeros_like(state)
        for was, chances in enumerate((same_a, other_a)):
            total = sum(chances) or 1.0
            after[0] += state[was] * chances[0] / total
            after[1, 1:] += state[was, :-1] * chances[1] / total
            after[1, -1] += state[was, -1] * chances[1] / total
        state = after
    return np.cumsum(state.sum(0))[:most + 1]


def thresholds(counts: np.ndarray, groups: list[list[int]], radius: int = RADIUS) -> tuple[float, list[int]]:
    """The cheapest thresholds that sum to radius - parts + 1, by dynamic programming over parts; -1 skips a part."""
    n, target = float(counts[BITS, 0]), radius - len(groups) + 1

    def cost(group: list[int], t: int) -> float:
        if t < 0:
            return 0.0
        # Keys made, a shuffled row each, and pairs that meet, each a comparison inside a task: about 1000 to 1.
        keys = n * (1 if t == 0 else len(group) + 1)
        return keys + n * n / 2 * differing(counts, group, 2)[t] * (1 if t == 0 else len(group) / 2) / 1000

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        after: dict[int, tuple[float, list[int]]] = {}
        for so_far, (spent, chosen) in best.items():
            for t in (-1, 0, 1, 2):
                entry = (spent + cost(group, t), [*chosen, t])
                if so_far + t not in after or entry < after[so_far + t]:
                    after[so_far + t] = entry
        best = after
    return best[target]


def plan(counts: np.ndarray, radius: int = RADIUS) -> tuple[list[list[int]], list[int]]:
    """Groups of bits and their thresholds, over 2 to radius + 1 parts."""
    found = []
    for parts in range(2, radius + 2):
        groups = grouped_bits(counts, parts)
        spent, chosen = thresholds(counts, groups, radius)
        found.append((spent, groups, chosen))
    _, groups, chosen = min(found)
    return groups, chosen


# Keys, verification and links


def gathered(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, moved together."""
    out = np.zeros(len(fps), np.uint64)
    for at, bit in enumerate(bits):
        out |= (fps >> np.uint64(bit) & ONE) << np.uint64(at)
    return out


def key_rows(fps: np.ndarray, groups: list[list[int]], chosen: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, value, fingerprint) of all keys."""
    parts, values, owners = [], [], []
    for i, (group, t) in enumerate(zip(groups, chosen)):
        if t < 0:
            continue
        own = gathered(fps, group)
        for flip in [0] if t == 0 else [0, *(1 << b for b in range(len(group)))]:
            parts.append(np.full(len(fps), i, np.int32))
            values.append(own ^ np.uint64(flip))
            owners.append(fps)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([*parts, np.zeros(0, np.int32)]), np.concatenate([*values, empty]), np.concatenate([*owners, empty])


def _keyed(fps: DataFrame, make) -> DataFrame:
    """(part, value, fp) rows from ``make(fingerprints, the other columns...)`` over Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part, value, fp = make(*(np.ascontiguousarray(c.to_numpy()) for c in batch.slice(at, BLOCK).columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(value.view(np.int64)), pa.array(fp.view(np.int64))], ["part", "value", "fp"]
                )
        release()

    return fps.mapInArrow(run, "part int, value long, fp long")


def forest(run: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest of its tree) that connect all pairs within ``radius`` inside runs of equal ``run``.

    ``run`` is sorted. Neighbours at growing distance are compared for all runs at once, long runs row by row.
    """
    n = len(fps)
    cuts = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(cuts, n))
    last = np.repeat(cuts + size, size)
    label = np.arange(n)
    left, right = [], []
    short = np.repeat(size, size) <= 64
    at = np.flatnonzero(short)
    for step in range(1, 64):
        at = at[at + step < last[at]]
        if not len(at):
            break
        near = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= radius]
        left.append(near)
        right.append(near + step)
    for a, k in zip(cuts[size > 64].tolist(), size[size > 64].tolist()):
        for i in range(a, a + k - 1):
            near = i + 1 + np.flatnonzero(np.bitwise_count(fps[i + 1:a + k] ^ fps[i]) <= radius)
            # One link per tree that row i meets is enough; labels are joined as rows are done.
            joined, first = np.unique(label[near], return_index=True)
            keep = near[first][joined != label[i]]
            if len(keep):
                top = min(int(label[i]), int(joined.min()))
                inside = slice(a, a + k)
                label[inside][np.isin(label[inside], np.append(joined, label[i]))] = top
                left.append(np.full(len(keep), i))
                right.append(keep)
    if not left:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    nodes, ends = np.unique(np.concatenate([fps[np.concatenate(left)], fps[np.concatenate(right)]]), return_inverse=True)
    a, b = ends[: len(ends) // 2], ends[len(ends) // 2:]
    top = np.arange(len(nodes))
    while True:  # smallest label over links, then over labels, until nothing changes
        before = top.copy()
        low = np.minimum(top[a], top[b])
        np.minimum.at(top, top[a], low)
        np.minimum.at(top, top[b], low)
        top = top[top]
        if (top == before).all():
            break
    linked = np.flatnonzero(top != np.arange(len(nodes)))
    return nodes[linked], nodes[top[linked]]


def links_of(keyed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between fingerprints that share a key of (part, value, fp) and lie within ``radius``.

    Keys are sorted within partitions; each task reads them as a stream and holds one key's fingerprints plus a batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, value, fp = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def linked(to: int) -> pa.RecordBatch:
            same = np.append(True, (part[1:to] == part[:to - 1]) & (value[1:to] == value[:to - 1]))
            a, b = forest(np.cumsum(~same), fp[:to], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            p, v, f = (np.ascontiguousarray(c.to_numpy()) for c in batch.columns)
            part, value, fp = np.concatenate([part, p]), np.concatenate([value, v]), np.concatenate([fp, f.view(np.uint64)])
            new = np.flatnonzero((part != part[-1]) | (value != value[-1])) if len(part) else part
            if len(new):  # all but the last key are complete
                to = int(new[-1]) + 1
                yield linked(to)
                part, value, fp = part[to:], value[to:], fp[to:]
        if len(part):
            yield linked(len(part))
        release()

    return keyed.repartition("part", "value").sortWithinPartitions("part", "value", "fp").mapInArrow(run, "a long, b long")


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, largest_key: int = LARGEST_KEY) -> DataFrame:
    """A linear number of links that connect all distinct fingerprints within ``radius`` of each other."""
    groups, chosen = plan(bit_counts(fps), radius)
    largest_key = max(16, largest_key)  # fewer could not be told apart by the last open bits
    keyed = staged(_keyed(fps.select("fp"), lambda x: key_rows(x.view(np.uint64), groups, chosen)))
    # The bits that a key's part leaves open. A value one bit away still leaves the part's bits open to two differences,
    # so only keys without flips fix bits; the others are split by all of their bits.
    open_bits = {i: [b for b in range(BITS) if chosen[i] > 0 or b not in group] for i, group in enumerate(groups)}
    found = None
    while True:
        crowded = staged(
            keyed.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > largest_key).select("part", "value")
        )
        none = crowded.isEmpty()
        ready = keyed if none else keyed.join(crowded, ["part", "value"], "left_anti")
        links = staged(links_of(ready, radius))
        found = links if found is None else found.unionAll(links)
        if none:
            return found
        # Each crowded key is split by the plain principle over its open bits: radius + 1 blocks, one of which agrees.
        # A key with few open bits has few distinct fingerprints, so this ends.
        blocks = {
            i: [bits[j::radius + 1] for j in range(radius + 1)] for i, bits in open_bits.items()
        }
        places = {(i, j): k for k, (i, j) in enumerate((i, j) for i in blocks for j in range(radius + 1))}

        def split(x, part, value, blocks=blocks, places=places):
            x, out = x.view(np.uint64), [[], [], []]
            for i in np.unique(part).tolist():
                mine = part == i
                for j, bits in enumerate(blocks[i]):
                    sub = gathered(x[mine], bits)
                    mixed = value[mine].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ sub  # a clash only adds comparisons
                    for to, v in zip(out, (np.full(mine.sum(), places[i, j], np.int32), mixed, x[mine])):
                        to.append(v)
            return tuple(np.concatenate(v) for v in out)

        keyed = staged(_keyed(keyed.join(crowded, ["part", "value"], "left_semi").select("fp", "part", "value"), split))
        open_bits = {places[i, j]: [b for b in open_bits[i] if b not in blocks[i][j]] for i, j in places}


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (smallest id reachable over links), group_size, same.

    NULL and empty texts have fingerprint 0 and are linked like any other. NULL ids are larger than none: a
    component whose ids are all NULL has component_id NULL. Repeated rows are nodes of their own with one fingerprint;
    ``same`` says how many rows of the component carry component_id. An empty table gives an empty result; other
    columns are ignored.
    """
    rows = staged(fingerprints(docs, id_column, text_column))
    each = staged(
        rows.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("same")).groupBy("fp")
        .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "same"))).alias("first"), F.sum("same").alias("n"))
    )
    found = components(fingerprint_links(each.select("fp"), radius))
    named = each.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = staged(named)
    tops = named.groupBy("component").agg(F.min("first").alias("top"), F.sum("n").alias("group_size"))
    groups = staged(named.join(tops, "component").select(
        "fp", "n", F.col("top.doc_id").alias("component_id"), F.col("top.same").alias("same"), "group_size"
    ))
    return spread_join(rows, groups, "fp", "n", rows.count()).drop("n")


def hex_fingerprint(column: str = "fp"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def without_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of each component, with all columns; other rows are never shuffled with their texts.

    Rows are told apart by id and a 128-bit digest of the text. The smallest id stays, NULL ids after all others; then the
    smallest fingerprint and digest decide. Of rows with one id and text, one stays: that of the smallest hash of all columns.
    """
    tag = F.unhex(F.md5(F.col(f"`{text_column}`"))).alias("tag")
    table = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), tag)
    kind = table.schema["doc_id"].dataType.simpleString()
    rows = map_rows(
        table, ["doc_id", "tag", "text"], f"doc_id {kind}, tag binary, fp long",
        lambda: lambda ids, tags, texts: (ids, tags, [fingerprint(t) for t in texts]),
    )
    rows = staged(rows.groupBy("fp", "doc_id", "tag").agg(F.count(F.lit(1)).alias("rows")))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", "tag")
    each = staged(rows.groupBy("fp").agg(F.min(order).alias("first")))
    found = components(fingerprint_links(each.select("fp"))).withColumnRenamed("node", "fp")
    tops = each.join(found, "fp", "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("top"))
    # A union instead of a join, as ids and digests may be NULL.
    none = F.lit(0).cast("long").alias("rows")
    marked = rows.select("doc_id", "tag", "rows", F.lit(False).alias("stays")).unionAll(
        tops.select("top.doc_id", "top.tag", none, F.lit(True).alias("stays"))
    )
    listed = staged(
        marked.groupBy(F.struct("doc_id", "tag").alias("key")).agg(F.sum("rows").alias("rows"), F.max("stays").alias("stays"))
        .filter("NOT stays OR rows > 1").select("key", "stays")
    )
    return apart(docs, F.struct(F.col(f"`{id_column}`").alias("doc_id"), tag), listed)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")
