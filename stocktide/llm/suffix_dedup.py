"""Repeated byte strings by prefix doubling over anchored positions.

A string of ``length`` bytes is repeated if it also starts anywhere else. Instead of a rank for every byte position,
positions are handled in runs: the anchor of a position p is the place of the smallest hash of a short string among the
``reach`` places from p on. It depends on the ``length`` bytes from p alone, so equal strings have their anchors at the
same distance, and a run of neighbouring positions shares one anchor. As in prefix doubling, ranks of growing strings
are sorted (shuffled) and compared, and whatever is unique is out:

- The first rank of a run is that of the short string at its anchor. Most are unique and end here.
- A run whose *cover*, all bytes of its positions' strings, is repeated as it is, is repeated as a whole.
- Otherwise the run is split. Of each part the *core*, what its positions' strings have in common, is the next rank. It is
  longer than the one before; a part with a unique core has no repeated string and is out. The last parts are single
  positions, whose core is the string itself.

One representative of each different cover goes on, so copies cost nothing further; of rows that repeat an id and its text,
at most one a task does. Ranks are 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.hot import MAX_BITS, apart_by, bits_for, bitmaps_of, spread_join
from stocktide.llm.worker import Bounded, map_rows, per_worker, release, slices_by_bytes
from stocktide.storage import discard, staged

LENGTH = 200
#: Positions that are searched for the smallest hash; the short string at an anchor has LENGTH - REACH + 1 bytes.
REACH = 160
#: Bytes that are handled at a time; longer texts are cut into overlapping parts.
BLOCK = 1 << 18
#: Runs a task remembers as already split.
REMEMBERED = 1 << 14
LOW = np.uint64((1 << 24) - 1)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value, powers of an odd base modulo 2**64, and their inverses."""
    letter = np.random.default_rng(200).integers(0, 1 << 64, 256, np.uint64)
    base = 0x9E3779B97F4A7C15
    n = BLOCK + 2 * LENGTH
    power = np.cumprod(np.append(np.uint64(1), np.full(n, base, np.uint64)), dtype=np.uint64)
    inverse = np.cumprod(np.append(np.uint64(1), np.full(n, pow(base, -1, 1 << 64), np.uint64)), dtype=np.uint64)
    return letter, power, inverse


def string_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each place on; a polynomial, so all of them come from prefix sums."""
    letter, power, inverse = per_worker("suffix_dedup", _tables)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(letter[data] * power[: len(data)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * inverse[: len(data) - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def window_minima(values: np.ndarray, reach: int) -> np.ndarray:
    """Smallest of ``reach`` values from each place on, by minima of blocks from both ends."""
    n = len(values) - reach + 1
    padded = np.full(-(-len(values) // reach) * reach, np.uint64((1 << 64) - 1))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, reach)
    to = np.minimum.accumulate(blocks, axis=1).ravel()
    since = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:n], to[reach - 1:reach - 1 + n])


@dataclass
class Runs:
    """Runs of positions with one anchor: text index, anchor, first and last position, hash at the anchor."""

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    h: np.ndarray


def runs(texts: list[bytes], length: int = LENGTH, reach: int = REACH) -> Iterator[Runs]:
    """All runs of some texts, part by part; a part holds at most about BLOCK bytes."""
    parts: list[tuple[int, int, bytes]] = []
    held = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, BLOCK // 2):
            part = text[at:at + BLOCK // 2 + length - 1]
            if held + len(part) > BLOCK:
                yield _runs(parts, length, reach)
                parts, held = [], 0
            parts.append((i, at, part))
            held += len(part)
    if parts:
        yield _runs(parts, length, reach)


def _runs(parts: list[tuple[int, int, bytes]], length: int, reach: int) -> Runs:
    data = np.frombuffer(b"".join(p for _, _, p in parts), np.uint8)
    h = string_hashes(data, length - reach + 1)
    order = h & ~LOW | np.arange(len(h), dtype=np.uint64)
    anchor = (window_minima(order, reach) & LOW).astype(np.int64)
    size = np.array([len(p) for _, _, p in parts])
    starts = np.cumsum(size) - size
    inside = np.ones(len(anchor) + 1, bool)[: len(anchor)]
    for s in (starts + size - length + 1)[:-1].tolist():  # strings that would cross into the next text
        inside[s:s + length - 1] = False
    p = np.flatnonzero(inside)
    a = anchor[p]
    cut = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)))
    first, last, a = p[cut], p[np.append(cut[1:], len(p)) - 1], a[cut]
    part = np.searchsorted(starts, first, "right") - 1
    shift = np.array([at for _, at, _ in parts]) - starts
    return Runs(np.array([i for i, _, _ in parts])[part], a + shift[part], first + shift[part], last + shift[part], h[a])


def rank_of(data: bytes, low: int, high: int) -> bytes:
    """The rank of a string at a given distance from its anchor."""
    return xxhash.xxh3_128_digest(b"%d,%d," % (low, high) + data)


# Splitting of runs; a run is kept by the distances low <= l <= high of its positions in front of the anchor.


@dataclass
class Levels:
    length: int = LENGTH
    reach: int = REACH
    starts: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self):
        """Borders of the parts of all distances, level by level: quarters, quarters of these, ..., single ones."""
        borders = [0, self.reach]
        while max(b - a for a, b in zip(borders, borders[1:])) > 1:
            finer = []
            for a, b in zip(borders, borders[1:]):
                finer += range(a, b, max(1, -(-(b - a) // 4)))
            borders = [*finer, self.reach]
            self.starts.append(np.array(borders))

    def children(self, level: int, low: int, high: int) -> Iterator[tuple[int, int, int, int]]:
        """(from, to, low, high): the parts from <= l < to that a run touches, and the run's share of each."""
        borders = self.starts[level]
        i = int(np.searchsorted(borders, low, "right")) - 1
        while borders[i] <= high:
            a, b = int(borders[i]), int(borders[i + 1])
            yield a, b, max(a, low), min(b - 1, high)
            i += 1
            if i == len(borders) - 1:
                break


def bloom(hashes: DataFrame, max_bits: int) -> np.ndarray:
    """A Bloom filter over anchor hashes ``h``, of bounded size, as bytes."""
    bits = bits_for(hashes.count(), max_bits)
    mask = F.lit(bits - 1).cast("long")
    slots = [F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 31).bitwiseAND(mask)]
    found = np.zeros(bits // 8, np.uint8)
    for r in bitmaps_of(hashes.select(F.explode(F.array(*[s + 1 for s in slots])).alias("slot"))).toLocalIterator():
        at = (r["bucket"] - 1) * 4096
        found[at:at + 4096] = np.frombuffer(r["bitmap"], np.uint8)
    return found


def in_bloom(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    out, mask = np.ones(len(h), bool), np.uint64(8 * len(found) - 1)
    for slot in (h & mask, h >> np.uint64(31) & mask):
        out &= (found[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return out


def _bytes(texts: list) -> list[bytes]:
    return [b"" if t is None else t if isinstance(t, bytes) else t.encode() for t in texts]


def _anchor_hashes(docs: DataFrame, length: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices_by_bytes(batches, "text"):
            for r in runs(_bytes(part.column(0).to_pylist()), length, reach):
                yield pa.RecordBatch.from_arrays([pa.array(r.h.view(np.int64))], ["h"])
        release()

    return docs.select("text").mapInArrow(run, "h long")


def _owner(doc_id: object, tag: bytes | None) -> bytes:
    """What the rows of one id and text have in common."""
    return repr(doc_id).encode() + (tag or b"")


def _ident(cover: bytes, owner: bytes, at: int) -> int:
    """A number for one part of a run of one id and text; clashes only let more rows through a filter."""
    return xxhash.xxh64_intdigest(b"%b,%d," % (owner, at) + cover) - (1 << 63)


def _idents(r: Runs, owners: np.ndarray) -> np.ndarray:
    """The numbers of whole runs, from their texts' owners (hashed) and their places alone: without their bytes."""
    x = owners[r.text]
    for values, factor in ((r.at, 0x9E3779B97F4A7C15), (r.first, 0xC2B2AE3D27D4EB4F), (r.last, 0x165667B19E3779F9)):
        x = (x ^ values.astype(np.uint64)) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    x = (x ^ r.h) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _first_of(seen: Bounded, owner: bytes, at: int, low: int, high: int) -> bool:
    """Whether a task meets a run for the first time, as far as it remembers: rows that repeat an id and its text have equal
    runs, of which one goes on."""
    run = xxhash.xxh3_128_digest(b"%b,%d,%d,%d" % (owner, at, low, high))
    if run in seen:
        return False
    seen.room_for(1)
    seen[run] = True
    return True


def _selected(
    texts: list[bytes], owners: list[bytes], bits: np.ndarray, length: int, reach: int, chosen: np.ndarray | None = None
) -> Iterator[tuple]:
    """(text, anchor, low, high, hash, ident, cover) of the runs whose anchor hash, and ident if asked, the filters have."""
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, owners), np.uint64, len(owners))
    for r in runs(texts, length, reach):
        some = np.flatnonzero(in_bloom(bits, r.h))
        r = Runs(*(x[some] for x in (r.text, r.at, r.first, r.last, r.h)))
        ident = _idents(r, hashed)
        if chosen is not None:
            some = np.flatnonzero(in_bloom(chosen, ident.view(np.uint64)))
            r, ident = Runs(*(x[some] for x in (r.text, r.at, r.first, r.last, r.h))), ident[some]
        for text, at, first, last, h, number in zip(*(x.tolist() for x in (r.text, r.at, r.first, r.last, r.h.view(np.int64), ident))):
            yield text, at, at - last, at - first, h, number, texts[text][first:last + length]


def _runs_of(docs: DataFrame, shared, length: int, reach: int) -> DataFrame:
    """The runs whose anchor hash the shared filter has, with the rank of their cover."""

    def start():
        bits = shared.value

        def found(ids, tags, texts):
            out = [[] for _ in range(8)]
            for text, at, low, high, h, ident, cover in _selected(_bytes(texts), list(map(_owner, ids, tags)), bits, length, reach):
                for values, v in zip(out, (ids[text], tags[text], at, low, high, h, rank_of(cover, low, high), ident)):
                    values.append(v)
            return out

        return found

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, tag binary, at long, low int, high int, h long, cover binary, ident long"
    return map_rows(docs, ["doc_id", "tag", "text"], schema, start, by="text")


def _repeated(found: DataFrame, hashes: DataFrame, max_bits: int) -> DataFrame:
    """Stored runs. A filter with room lets hardly any others through, which do no harm; one that is too full for the
    hashes (h, n) is followed by a join with them."""
    found = staged(found)
    if 8 * hashes.count() <= max_bits:
        return found
    total = hashes.agg(F.sum("n")).first()[0]
    joined = staged(spread_join(found, hashes, "h", "n", total).filter("n IS NOT NULL").drop("n"))
    discard(found)
    return joined


NODE = "doc_id {kind}, tag binary, at long, low int, high int, core binary, cover binary, ident long, parent long, bytes binary"


def _parts(row: tuple, ident: int, data: bytes, levels: Levels, level: int, out: list[list]) -> None:
    """Add the parts of a run at the next level: core's and cover's rank, and the bytes of the cover."""
    doc_id, tag, at, low, high = row
    owner = _owner(doc_id, tag)
    for a, b, lo, hi in levels.children(level, low, high):
        # data starts at distance ``high``; the part's outermost positions are a and b - 1
        core = data[high - a:high - (b - 1) + levels.length]
        cover = data[high - hi:high - lo + levels.length]
        rank = rank_of(cover, lo, hi)
        made = (doc_id, tag, at, lo, hi, rank_of(core, a, b), rank, _ident(rank, owner, at), ident, cover)
        for values, v in zip(out, made):
            values.append(v)


def _first_parts(docs: DataFrame, hashes, chosen, levels: Levels) -> DataFrame:
    """The first parts of the runs whose anchor hash and whose ident the shared filters have."""

    def start():
        by_hash, by_ident, seen = hashes.value, chosen.value, Bounded(REMEMBERED)

        def split(ids, tags, texts):
            owners = list(map(_owner, ids, tags))
            out = [[] for _ in range(10)]
            for text, at, low, high, _, ident, cover in _selected(_bytes(texts), owners, by_hash, levels.length, levels.reach, by_ident):
                if _first_of(seen, owners[text], at, low, high):
                    _parts((ids[text], tags[text], at, low, high), ident, cover, levels, 0, out)
            return out

        return split

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs, ["doc_id", "tag", "text"], NODE.format(kind=kind), start, by="text")


def _next_parts(nodes: DataFrame, chosen, levels: Levels, level: int) -> DataFrame:
    """The parts of the nodes whose ident the shared filter has. Their bytes are never shuffled."""

    def start():
        by_ident, seen = chosen.value, Bounded(REMEMBERED)

        def split(ids, tags, ats, lows, highs, idents, datas):
            out = [[] for _ in range(10)]
            keep = in_bloom(by_ident, np.array(idents, np.int64).view(np.uint64))
            for doc_id, tag, at, low, high, ident, data, wanted in zip(ids, tags, ats, lows, highs, idents, datas, keep):
                if wanted and _first_of(seen, _owner(doc_id, tag), at, low, high):
                    _parts((doc_id, tag, at, low, high), ident, data, levels, level, out)
            return out

        return split

    kind = nodes.schema["doc_id"].dataType.simpleString()
    return map_rows(nodes, ["doc_id", "tag", "at", "low", "high", "ident", "bytes"], NODE.format(kind=kind), start)


def _to_split(classes: DataFrame, core: str) -> DataFrame:
    """(ident, settled) of one run per different cover, for all covers of a core that has several, one of them open."""
    cores = classes.groupBy(core).agg(F.count(F.lit(1)).alias("ways"), F.count(F.when(~F.col("settled"), 1)).alias("open"))
    cores = staged(cores.filter("ways > 1 AND open > 0").select(core, "ways"))
    down = spread_join(classes.select(core, "ident", "settled"), cores, core, "ways", classes.count())
    out = staged(down.filter("ways IS NOT NULL").groupBy("ident").agg(F.max("settled").alias("settled")))
    discard(cores)
    return out


def repeated_spans(docs: DataFrame, length: int = LENGTH, reach: int = REACH, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, tag, start, stop): byte spans that together are all bytes of repeated strings; spans may overlap.

    ``docs`` has doc_id, tag and text; equal (doc_id, tag) must mean equal texts. It is read three times, and a text
    is never shuffled here. What a round has used up is removed from the shared folder.
    """
    spark, levels = docs.sparkSession, Levels(length, reach)
    share = lambda hashes: spark.sparkContext.broadcast(bloom(hashes, max_bits))
    span = [F.col("doc_id"), F.col("tag"), (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("stop")]

    # Runs whose anchor's short string is repeated, and their different covers.
    hashes = staged(_anchor_hashes(docs, length, reach).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    by_hash = share(hashes)
    runs_ = _repeated(_runs_of(docs, by_hash, length, reach), hashes, max_bits)
    covers = staged(
        runs_.groupBy("cover").agg(F.count(F.lit(1)).alias("n"), F.first("h").alias("h"), F.first("ident").alias("ident"))
        .withColumn("settled", F.col("n") > 1)
    )
    # A run is repeated as a whole unless its cover is the only one of its kind.
    single = staged(covers.filter("NOT settled").select(F.col("cover").alias("key"), F.lit(True).alias("single")))
    _, whole = apart_by(runs_.select("doc_id", "tag", "at", "low", "high", F.col("cover").alias("key")), single, max_bits)
    found = [staged(whole.select(span))]
    down = _to_split(covers, "h")
    discard(hashes, runs_, covers, single)

    nodes = None
    for level in range(len(levels.starts)):
        if down.isEmpty():
            break
        chosen = share(down.select(F.col("ident").alias("h")))
        before, above = nodes, down
        nodes = staged(_first_parts(docs, by_hash, chosen, levels) if level == 0 else _next_parts(nodes, chosen, levels, level))
        sizes = nodes.groupBy("parent").agg(F.count(F.lit(1)).alias("size"))
        parents = staged(sizes.join(above.select(F.col("ident").alias("parent"), "settled"), "parent"))
        light = spread_join(nodes.drop("bytes"), parents, "parent", "size", nodes.count())
        light = staged(light.filter("size IS NOT NULL").drop("parent", "size"))
        classes = staged(
            light.groupBy("core", "cover").agg(
                F.count(F.lit(1)).alias("n"), F.max("settled").alias("done"), F.first("ident").alias("ident")
            ).withColumn("settled", F.col("done") | (F.col("n") > 1))
        )
        again = classes.filter("settled").select("cover", F.col("n").alias("size"))
        new = light.filter("NOT settled").select("doc_id", "tag", "at", "low", "high", "cover")
        found.append(staged(spread_join(new, again, "cover", "size", light.count()).filter("size IS NOT NULL").select(span)))
        down = _to_split(classes, "core")
        discard(above, parents, light, classes, *([] if before is None else [before]))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlap; touching ones are one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def without_spans(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, stop in spans:
        parts.append(data[at:start])
        at = stop
    return b"".join([*parts, data[at:]])


def at_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans drawn in to whole characters of UTF-8, so that what is left is text again."""
    def inner(start: int, stop: int) -> tuple[int, int]:
        while start < stop and data[start] & 0xC0 == 0x80:
            start += 1
        while stop > start and stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop -= 1
        return start, stop

    return [(a, b) for a, b in (inner(*s) for s in spans) if a < b]


def _with_spans(docs: DataFrame, id_column: str, text_column: str, length: int, reach: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row, key, spans) with repeated strings, and rows (row, key) without; only the first are shuffled.

    Texts that share an id are told apart by 128 bits of their digest."""
    key = F.struct(F.col(f"`{id_column}`").alias("doc_id"), F.unhex(F.md5(F.col(f"`{text_column}`"))).alias("tag"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"))
    texts = docs.select(key["doc_id"].alias("doc_id"), key["tag"].alias("tag"), F.col(f"`{text_column}`").alias("text"))
    spans = repeated_spans(texts, length, reach, max_bits)
    by_text = staged(
        spans.distinct().groupBy(F.struct("doc_id", "tag").alias("key")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    return apart_by(whole, by_text, max_bits)


def repeated_bytes(
    docs: DataFrame, length: int = LENGTH, reach: int = REACH, max_bits: int = MAX_BITS,
    id_column: str = "doc_id", text_column: str = "text", kept: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked, spans and kept bytes).

    Removes each byte covered by a string of ``length`` bytes that also starts anywhere else, in the same text or
    another; NULL counts as the empty text. Repeated rows and equal texts are repeats of each other. Texts shorter than
    ``length`` and NULL ids are fine; an empty table gives an empty result; other columns are ignored.
    """
    listed, rest = _with_spans(docs.select(id_column, text_column), id_column, text_column, length, reach, max_bits)
    text = F.coalesce(F.col(f"row.`{text_column}`"), F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    more = ", spans array<struct<start:long,stop:long>>, kept binary"

    def cut(ids, texts, spans):
        out = [[] for _ in range(7)]
        for doc_id, found, where in zip(ids, _bytes(texts), spans):
            where = merged([(s["start"], s["stop"]) for s in where])
            left = without_spans(found, where)
            row = (doc_id, len(found), len(found) - len(left), len(where), hashlib.sha256(left).hexdigest(), where, left)
            for values, v in zip(out, row):
                values.append(v)
        return out if kept else out[:5]

    changed = map_rows(listed, [F.col("key.doc_id").alias("doc_id"), text.alias("text"), "spans"], schema + more * kept, lambda: cut, by="text")
    none = [F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"), text.cast("binary").alias("kept")]
    same = rest.select(
        F.col("key.doc_id").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text.cast("binary"), 256).alias("kept_sha256"), *(none if kept else []),
    )
    return changed.unionAll(same)


def without_repeated_strings(
    docs: DataFrame, length: int = LENGTH, reach: int = REACH, max_bits: int = MAX_BITS,
    id_column: str = "doc_id", text_column: str = "text", size_column: str | None = "n_chars",
) -> DataFrame:
    """All rows and columns, the texts without repeated strings (cut at whole characters) and the size column to match."""
    listed, rest = _with_spans(docs, id_column, text_column, length, reach, max_bits)

    def cut(rows_text, spans):
        found = _bytes(rows_text)
        left = [without_spans(d, at_characters(d, merged([(s["start"], s["stop"]) for s in w]))) for d, w in zip(found, spans)]
        return [d.decode() for d in left]

    schema = listed.schema["row"].dataType
    keep = [c for c in docs.columns if c != text_column]

    def start():
        def run(*columns):
            *others, texts, spans = columns
            return [*others, cut(texts, spans)]

        return run

    from pyspark.sql import types as T

    out = T.StructType([schema[c] for c in keep] + [T.StructField(text_column, T.StringType())])
    # by place, so that no column of the table can clash with an added one
    columns = [F.col(f"row.`{c}`").alias(f"c{i}") for i, c in enumerate([*keep, text_column])] + [F.col("spans").alias("spans")]
    changed = map_rows(listed.select(*columns), [f"c{i}" for i in range(len(keep) + 1)] + ["spans"], out, start, by=f"c{len(keep)}").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
    if size_column in docs.columns:
        kind = docs.schema[size_column].dataType
        changed = changed.withColumn(size_column, F.length(F.col(f"`{text_column}`")).cast(kind))
    return changed.unionAll(rest.select("row.*"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
