"""Document probability under a subword lattice: every segmentation of every word counts, weighted by a fixed vocabulary.

The pieces are the entries of an existing vocabulary and all single bytes. Their weights start as a power law of the vocabulary's
own scores (its entries are in order of their merges, most frequent first) and are fitted to the training documents by expectation
maximisation over all segmentations; the vocabulary itself is never trained. A document is its words, each behind a space, and one end. No
piece holds a space but at its start, so the sum over a document's segmentations is the product of those of its words, and
each different word of the corpus is summed once, by the forward recursion in log space.

Word counts, sums and look-ups are Spark aggregations and joins; the rows that Python sees are different words and documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stocktide.llm.worker import slices_by_bytes
from stocktide.storage import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: How sentencepiece writes a space.
SPACE = "▁"
#: Rounds of expectation maximisation, and the weight of the vocabulary's own scores, in pieces.
ROUNDS, PRIOR = 3, 1000.0
#: Words whose values are broadcast at most, the most frequent first; none of their keys is longer than this.
HOT_WORDS, KEY_BYTES = 1 << 17, 64
#: Letters of the words that are summed at a time.
BATCH_LETTERS = 1 << 20
LN10 = math.log(10)


def vocabulary(model: bytes) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model as bytes, and every single byte, with weights that sum to one.

    A vocabulary of merges scores its entries by minus their rank, so a weight falls with the rank like a word's frequency does.
    """
    import sentencepiece

    b = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = b.get_piece_size()
    rank = {bytes([i]): n for i in range(256)}
    for i in range(n):
        piece = b.id_to_piece(i).replace(SPACE, " ").encode()
        plain = not (b.is_control(i) or b.is_unknown(i) or b.is_byte(i) or b.is_unused(i))
        if plain and b" " not in piece[1:] and not re.search(rb"[A-Z\x09-\x0d]", piece):  # words hold none of these
            rank[piece] = min(rank.get(piece, n), int(-b.get_score(i)))
    weights = 1 / (np.array(list(rank.values())) + 10.0)
    return list(rank), weights / weights.sum()


class Lattice:
    """Sums over all segmentations of words; a word is a space and its letters."""

    def __init__(self, pieces: list[bytes], weights: np.ndarray):
        import ahocorasick

        self.log, self.longest = np.log(weights), max(map(len, pieces))
        self.found = ahocorasick.Automaton()
        for i, piece in enumerate(pieces):
            self.found.add_word(piece.decode("latin-1"), i * 64 + len(piece))
        if self.longest > 63:
            raise ValueError("a piece is too long")
        self.found.make_automaton()

    def edges(self, words: list[bytes]):
        """Of all words, one node a byte and one before the first: start, end and piece of every match, and the words' first nodes."""
        texts = [" " + w.decode("latin-1") for w in words]
        found = self.found.iter("Ā".join(texts))  # the letter between words is in no piece
        ends, values = np.fromiter(chain.from_iterable(found), np.int64).reshape(-1, 2).T.copy()  # number by number, no list of all matches
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        ends += 1  # a word's nodes are as many as its letters and the separator
        return ends - values % 64, ends, values // 64, firsts

    @staticmethod
    def _levels(depth: np.ndarray, order: np.ndarray | None = None) -> list[np.ndarray]:
        """Edges by depth, one depth at a time, each in the given order."""
        small = depth.astype(np.uint16) if depth.max(initial=0) < 1 << 16 else depth  # short numbers are sorted faster
        order = np.argsort(small, kind="stable") if order is None else order[np.argsort(small[order], kind="stable")]
        return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)

    @staticmethod
    def _pass(nodes: np.ndarray, source: np.ndarray, target: np.ndarray, weight: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Add up in log space along the edges, all words at once, a level of targets after the other; equal targets are neighbours."""
        for cut in levels:
            to = target[cut]
            heads = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            nodes[to[heads]] = np.logaddexp.reduceat(nodes[source[cut]] + weight[cut], heads)
        return nodes

    def _forward(self, words):
        start, end, piece, firsts = self.edges(words)
        of = np.repeat(np.arange(len(words)), np.diff(np.searchsorted(end, firsts)))  # edges come in the order of their ends
        weight = self.log[piece]
        ahead = np.full(firsts[-1], -np.inf)
        ahead[firsts[:-1]] = 0
        self._pass(ahead, start, end, weight, self._levels(end - firsts[of]))
        return ahead, start, end, piece, weight, of, firsts

    def log10(self, words: list[bytes]) -> np.ndarray:
        """The marginal log10 probability of each word."""
        ahead, *_, firsts = self._forward(words)
        return ahead[firsts[1:] - 1] / LN10

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, over all segmentations, by the forward and backward sums."""
        ahead, start, end, piece, weight, of, firsts = self._forward(words)
        last = firsts[of + 1] - 1
        back = np.full(firsts[-1], -np.inf)
        back[firsts[1:] - 1] = 0
        self._pass(back, end, start, weight, self._levels(last - start, np.argsort(start, kind="stable")))
        share = np.exp(ahead[start] + weight + back[end] - ahead[last])
        return np.bincount(piece, share * times[of], len(self.log))


def bounded(words: list[bytes]) -> Iterator[list[int]]:
    """Places of words by parts of about ``BATCH_LETTERS`` letters, words of like length together, so that a long one delays no others."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    part, size = [], 0
    for i in order:
        part.append(i)
        size += len(words[i]) + 1
        if size >= BATCH_LETTERS or (len(part) > 1 and len(words[i]) > 1024):
            yield part
            part, size = [], 0
    if part:
        yield part


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none of a NULL text."""
    found = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x20\\x09-\\x0D]+")
    return F.filter(found, lambda w: w != "")


def split_words(text: str | None) -> list[bytes]:
    """The words as UTF-8: bytes split at space and the five controls from tab on, which is what a word ends at."""
    return text.encode().translate(TO_LOWER).split() if text else []


def keys_of(words: list[bytes]) -> list[bytes]:
    """Each word itself, or a digest behind a space where it is long; no word holds a space."""
    if not words or max(map(len, words)) <= KEY_BYTES:
        return words
    return [w if len(w) <= KEY_BYTES else b" " + hashlib.sha256(w).hexdigest()[:KEY_BYTES - 1].encode() for w in words]


class Places(dict):
    """Places by key; a key that is not there has the place after the last."""

    def __missing__(self, key: bytes) -> int:
        return len(self)


def key_column(word: Column) -> Column:
    return F.when(F.octet_length(word) <= KEY_BYTES, word).otherwise(F.concat(F.lit(" "), F.substring(F.sha2(word, 256), 1, KEY_BYTES - 1)))


def word_table(docs: DataFrame) -> DataFrame:
    """(word, c, times) of ``docs`` (text, held_out): how often each word is in the training documents and in all."""
    return (
        docs.select(F.col("held_out"), F.explode(words_of(F.col("text"))).alias("word"))
        .groupBy("word").agg(F.sum(F.when(F.col("held_out"), 0).otherwise(1)).alias("c"), F.count("*").alias("times"))
    )


def fitted(table: DataFrame, pieces: list[bytes], weights: np.ndarray, ends: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights of the pieces and of the end, fitted to the words and ends of training.

    A round expects pieces in all different words, weighted by their counts; tasks add up first, so a row per piece and task is shuffled and
    one per piece, bounded by the vocabulary, reaches the driver.
    """
    sc = table.sparkSession.sparkContext
    kind = T.StructType.fromDDL("piece int, expected double")
    prior, end = weights, 1e-3
    known = table.filter("c > 0").select("word", "c")
    for _ in range(rounds):
        shared = sc.broadcast((pieces, weights))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(*shared.value), np.zeros(len(shared.value[0]))
            for batch in batches:
                words, times = [w.encode() for w in batch.column("word").to_pylist()], batch.column("c").to_numpy()
                for part in bounded(words):
                    total += lattice.expected([words[i] for i in part], times[part])
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], schema=to_arrow_schema(kind))

        found = known.mapInArrow(run, kind).groupBy("piece").agg(F.sum("expected").alias("expected")).toArrow()
        expected = np.zeros(len(pieces))
        expected[found.column("piece").to_numpy()] = found.column("expected").to_numpy()
        total = expected.sum() + ends + PRIOR
        weights, end = (expected + (PRIOR - 1) * prior) / total, (ends + 1) / total
    return weights, end


def with_lattice(table: DataFrame, pieces: list[bytes], weights: np.ndarray) -> DataFrame:
    """Add log10 of each different word's marginal probability."""
    shared = table.sparkSession.sparkContext.broadcast((pieces, weights))
    kind = T.StructType([*table.schema.fields, T.StructField("lattice", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, schema = Lattice(*shared.value), to_arrow_schema(kind)
        for batch in batches:
            words = [w.encode() for w in batch.column("word").to_pylist()]
            found = np.zeros(len(words))
            for part in bounded(words):
                found[part] = lattice.log10([words[i] for i in part])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], schema=schema)

    return table.mapInArrow(run, kind)


def lattice_scores(
    docs: DataFrame, model: str, held_out: Column, id_column: str = "doc_id", text_column: str = "text", hot_words: int = HOT_WORDS
) -> DataFrame:
    """Score every text by the lattice, and by single word counts.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per input row. ``held_out`` marks the rows that
    teach nothing (NULL: they teach). ``model`` is the path of a sentencepiece file on the driver. NULL counts as the empty text, which is one
    end. Repeated rows and NULL ids each give their own row and each teach; an empty table gives an empty result; without any
    training row the vocabulary's own scores stand and no word is known. Other columns are ignored.

    The values of at most ``hot_words`` words, the most frequent, are broadcast (keys of at most ``KEY_BYTES`` bytes), and each text sums
    theirs where it is read; the rest of its words are joined to their values by a shuffle. No rest word is hot, by choice.
    """
    spark = docs.sparkSession
    with open(model, "rb") as f:
        pieces, weights = vocabulary(f.read())
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    table = staged(word_table(rows))
    ends = rows.filter("NOT held_out").count()
    n, known = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    n, v = n + ends, known + (ends > 0)
    weights, end = fitted(table, pieces, weights, ends)
    base = F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    valued = staged(with_lattice(table, pieces, weights).select(key_column(F.col("word")).alias("key"), "times", (F.col("c") > 0).alias("known"), base.alias("base"), "lattice"))
    least = _least_times(valued, hot_words)
    hot = valued.filter(F.col("times") >= least).toArrow()
    shared = spark.sparkContext.broadcast(
        (hot.column("key").to_pylist(), *(hot.column(c).to_numpy() for c in ("known", "base", "lattice")))
    )
    kind = T.StructType.fromDDL(
        f"doc_id {docs.schema[id_column].dataType.simpleString()}, held_out boolean, n_tokens long, known long, base double, lattice double, rest array<string>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *values = shared.value
        place = Places((k.encode(), i) for i, k in enumerate(keys))
        values = [np.append(x.astype(np.float64), 0.0) for x in values]  # the last stands for a word of the rest
        schema = to_arrow_schema(kind)
        for part in slices_by_bytes(batches, "text"):
            found = [keys_of(split_words(t)) for t in part.column("text").to_pylist()]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            every = list(chain.from_iterable(found))
            at = np.fromiter(map(place.__getitem__, every), np.int64, len(every))
            text = np.repeat(np.arange(len(found)), counts)
            known, based, summed = (np.bincount(text, x[at], len(found)) for x in values)
            missing = np.flatnonzero(at == len(keys))
            to = np.searchsorted(text[missing], np.arange(len(found) + 1)).astype(np.int32)
            rest = pa.array([every[i].decode() for i in missing.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(counts + 1), pa.array(known.astype(np.int64)),
                 pa.array(based), pa.array(summed), pa.ListArray.from_arrays(pa.array(to), rest, type=schema.field("rest").type)], schema=schema)

    read = staged(rows.mapInArrow(run, kind).withColumn("row", F.monotonically_increasing_id()))
    rare = valued.filter(F.col("times") < least)
    sums = (
        read.select("row", F.explode("rest").alias("key")).join(rare, "key").groupBy("row")
        .agg(F.count(F.when(F.col("known"), 1)).alias("more_known"), F.sum("base").alias("more_base"), F.sum("lattice").alias("more_lattice"))
    )
    end_base = math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return read.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("more_known") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + zero("more_base") + end_base).alias("base_score"),
        (F.col("lattice") + zero("more_lattice") + math.log10(end)).alias("score"),
    )


def _least_times(valued: DataFrame, room: int) -> int:
    """The number of times from which at most ``room`` words are: by powers of a quarter of two, so few numbers are read."""
    level = F.floor(4 * F.log2("times")).cast("int")
    least = None
    for r in valued.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("times").alias("least")).orderBy(F.desc("level")).collect():
        if r["n"] > room:
            break
        least, room = r["least"], room - r["n"]
    return (1 << 62) if least is None else least


def op13_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return lattice_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"), held_out)
