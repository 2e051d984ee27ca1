"""Best-fit packing of tokenised documents into sequences of a fixed length, after a dominance reduction.

Documents become pieces of 1 to ``capacity`` tokens. Only how many pieces have each length matters for the plan, so the
plan is made from at most ``capacity`` counts, however many documents there are:

1. Reduction (Martello and Toth): for the longest length, a set of one to three pieces is fixed for good when it
   provably dominates every other way to fill its sequence; this is repeated for as many sequences as the proof holds.
2. Best fit, longest first, over the counts that remain.

The plan is a list of fillings with multiplicities. Pieces then get their rank within their length, distributed,
and the rank decides the place.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.tokens import COMMON, byte_letters, read_text
from stocktide.llm.worker import Bounded, Recent, map_rows, per_worker, renamed
from stocktide.storage import staged

#: Words a worker remembers, about 200 bytes each.
REMEMBERED = 300_000
#: Pieces that one task ranks within one length.
RANKED = 100_000
#: Marks that end many words; a run of them behind letters is one piece of the split. The apostrophe is none, it may start a piece.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters that Python takes as blanks and the tokenizer's pattern does not.
UNSURE = re.compile("[\x1c-\x1f]")

Filling = list[tuple[int, int]]  # (length, how many) from the start of the sequence on


class WordIds:
    """Token ids as 32-bit little-endian bytes, by a tokenizer that drops white space.

    Its normaliser and split never look across white space, so each word's ids can be found once and remembered. In texts
    of common characters, normalising is lower-casing, so new words go straight to the tokenizer's merges; words of
    other texts take its whole way, all new ones of a text in one call, parted by a special token.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        first, second = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or first["type"] != "Split" or second["type"] != "ByteLevel" or second["use_regex"]:
            raise ValueError("the tokenizer normalises or splits in another way")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split, self.model = regex.compile(first["pattern"]["Regex"]).findall, self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        self.special, (self.border, self.border_id) = [s for s, _ in special], special[0]
        self.known, self.marks = Recent(REMEMBERED), Bounded(10_000)

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def merged(self, word: str) -> bytes:
        """Ids of a word of common characters in lower case."""
        letters = word.rstrip(MARKS)
        if not letters.isalpha():
            return b"".join(map(self.piece, self.split(word)))
        marks = word[len(letters):]
        if marks not in self.marks:
            self.marks.room_for(1)
            self.marks[marks] = self.piece(marks) if marks else b""
        return (marks and self.known.get(letters) or self.piece(letters)) + self.marks[marks]

    def piece(self, piece: str) -> bytes:
        """Ids of one piece of the split."""
        shown = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(self.letters)
        tokens = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(tokens)}I", *tokens)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special) or UNSURE.search(text):
            return np.array(self.library(text), "<u4").tobytes()
        common = COMMON.fullmatch(text)
        words = (text.lower() if common else text).split()
        known, new = self.known.lacking(set(words))
        if common:
            known.update(zip(new, map(self.merged, new)))
        elif new:
            ids = np.array(self.library(self.border.join(new)), "<u4")
            cuts = np.flatnonzero(ids == self.border_id)
            starts, stops = np.append(0, cuts + 1), np.append(cuts, len(ids))
            data = ids.tobytes()
            for w, a, b in zip(new, (starts * 4).tolist(), (stops * 4).tolist()):
                known[w] = data[a:b]
        return b"".join(map(known.__getitem__, words))


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
    id_column: str = "doc_id", text_column: str = "text", ids: bool = False,
) -> DataFrame:
    """Documents cut into pieces: doc_id, piece, start, length, ids_crc32 and, if asked, the ids (32-bit, little-endian).

    A document is its token ids and ``end_id``; NULL counts as the empty text (one piece of one token).
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_text(tokenizer))  # bounded by the vocabulary
    end = struct.pack("<I", end_id)

    def start():
        words = per_worker(("pieces", hash(shared.value)), lambda: WordIds(shared.value))

        def cut(doc_ids, texts):
            out = [[], [], [], [], [], []]
            for doc_id, text in zip(doc_ids, texts):
                data = words.encode(text) + end
                for piece, at in enumerate(range(0, len(data), capacity * 4)):
                    part = data[at:at + capacity * 4]
                    for values, v in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                        values.append(v)
            return out if ids else out[:5]

        return cut

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return map_rows(renamed(docs, doc_id=id_column, text=text_column), ["doc_id", "text"], schema, start, by="text")


class _Lengths:
    """How many pieces of each length are left."""

    def __init__(self, counts: dict[int, int]):
        self.count = {n: c for n, c in counts.items() if c > 0}
        self.order = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            self.order.remove(length)

    def at_most(self, room: int, without: dict[int, int]) -> int | None:
        """The longest length that fits and of which a piece is left besides ``without``."""
        i = bisect.bisect_right(self.order, room)
        while i and self.count[self.order[i - 1]] <= without.get(self.order[i - 1], 0):
            i -= 1
        return self.order[i - 1] if i else None

    def smallest(self, n: int, without: dict[int, int]) -> list[int]:
        found: list[int] = []
        for length in self.order:
            found += [length] * min(n - len(found), self.count[length] - without.get(length, 0))
            if len(found) == n:
                break
        return found


def _dominating(left: _Lengths, longest: int, capacity: int) -> list[int] | None:
    """The pieces to put beside a piece of length ``longest`` when that choice dominates all others, else None.

    One set dominates another when the other's pieces can be dealt onto its own, each onto one that is as long as
    all it gets: any packing with the other set can then be changed into one with this set and no more sequences.
    """
    room, own = capacity - longest, {longest: 1}
    best = left.at_most(room, own)
    if best is None:
        return []  # nothing fits beside it
    few = left.smallest(3, own)
    if best == room or len(few) < 2 or few[0] + few[1] > room:
        return [best]  # it fills the rest, or only one piece fits: the longest such piece takes any other's place
    if len(few) == 3 and sum(few) <= room:
        return None  # four pieces may fit, nothing is proved
    # At most two pieces fit beside it. The pair with the longest second piece: any pair's second is no longer.
    second, pair_sum = 0, 0
    for p in reversed(left.order[:bisect.bisect_right(left.order, room - few[0])]):
        q = left.at_most(min(p, room - p), {longest: 1, p: 1} if p != longest else {longest: 2})
        if left.count[p] <= own.get(p, 0) or q is None:
            continue
        second, pair_sum = max(second, q), max(pair_sum, p + q)
    if best >= pair_sum:
        return [best]  # any pair fits onto the longest single piece
    beside = left.at_most(min(best, room - best), {longest: 1 + (best == longest), best: 1 + (best == longest)})
    if beside is not None and beside >= second:
        return [best, beside]  # its first piece is the longest that fits, its second the longest of any second
    return None


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Filling, int]], dict[int, int]]:
    """Fillings that are fixed by dominance, with how often each occurs, and the counts that remain.

    Lengths are tried from the longest down. A length without a proof is set aside, because what is proved
    for others still holds while it stays in the instance.
    """
    left, fixed = _Lengths(counts), []
    for longest in sorted(left.count, reverse=True):
        while left.count.get(longest):
            beside = _dominating(left, longest, capacity)
            if beside is None:
                break
            need: dict[int, int] = defaultdict(int)
            for length in [longest, *beside]:
                need[length] += 1
            # Nothing or one piece beside: the proof holds until one of them runs out. Pairs are proved one by one.
            times = min(left.count[length] // n for length, n in need.items()) if len(beside) < 2 else 1
            for length, n in need.items():
                left.take(length, n * times)
            fixed.append((sorted(need.items(), reverse=True), times))
    return fixed, dict(left.count)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit over counts, longest first; sequences that are filled alike are kept as one entry with their number."""
    open_: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []
    done: list[tuple[Filling, int]] = []

    def put(filling: Filling, n: int, room: int) -> None:
        if not room:
            done.append((filling, n))
            return
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append((filling, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            i = bisect.bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                filling, there = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[i]
            else:  # new sequences
                room, filling, there = capacity, [], n
            each = room // length  # best fit stays with a sequence while it has room for this length
            full, rest = divmod(n, each)
            if there <= full:
                used, k = there, each
            elif full:
                used, k = full, each
            else:
                used, k = 1, rest
            put([*filling, (length, k)], used, room - k * length)
            if filling and there > used:
                put(filling, there - used, room)
            n -= used * k
    return done + [entry for room in rooms for entry in open_[room]]


def slots(plan: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """The plan as a table by (length, first rank): which sequence and offset a piece's rank within its length has."""
    rows, used, base = [], defaultdict(int), 0
    for filling, times in plan:
        offset = 0
        for length, k in filling:
            rows.append((length, used[length], base, k, offset))
            used[length] += k * times
            offset += k * length
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(("length", "first", "base", "each", "offset"))}


def packed(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...) that are stored, as they are read repeatedly.

    The driver sees one count per length, at most ``capacity`` of them. Pieces are ranked within parts of a length, by
    a hash of the document, so a length that holds most pieces is spread over many tasks.
    """
    spark = cut.sparkSession
    total = cut.count()
    parts = max(1, -(-total // RANKED))
    part = F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(parts))
    by_part = staged(cut.groupBy("length", part.alias("part")).agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).toLocalIterator()}
    fixed, rest = reduced(counts, capacity)
    table = spark.sparkContext.broadcast(slots(fixed + best_fit(rest, capacity)))

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("part", part).withColumn("rank", F.row_number().over(order)).join(starts, ["length", "part"])
    ranked = ranked.select(*cut.columns, (F.col("before") + F.col("rank") - 1).alias("rank"))

    def start():
        t = table.value
        firsts = {n: np.flatnonzero(t["length"] == n) for n in np.unique(t["length"]).tolist()}

        def place(*columns):
            length, rank = (np.array(columns[i], np.int64) for i in (names.index("length"), names.index("rank")))
            at = np.empty(len(rank), np.int64)
            for n in np.unique(length).tolist():
                mine, rows = length == n, firsts[n]
                at[mine] = rows[np.searchsorted(t["first"][rows], rank[mine], "right") - 1]
            inside = rank - t["first"][at]
            return [
                *columns[:-1], (t["base"][at] + inside // t["each"][at]).tolist(),
                (t["offset"][at] + inside % t["each"][at] * length).tolist(),
            ]

        return place

    names = ranked.columns
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    return map_rows(ranked, names, schema, start)


def best_fit_packing(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
    id_column: str = "doc_id", text_column: str = "text", ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked).

    Every piece is placed once; a sequence holds at most ``capacity`` tokens without gaps. NULL texts count as empty,
    NULL ids and repeated rows give pieces of their own, ties are placed in any order. An empty table gives
    an empty result; other columns are ignored.
    """
    return packed(staged(pieces(docs, tokenizer, capacity, end_id, id_column, text_column, ids)), capacity)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit_packing(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
