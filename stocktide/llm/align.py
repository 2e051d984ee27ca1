"""Alignment of two tokenizers' tokens over the same bytes, and which token pairs the corpus links most.

Interval coalescing: all tokens of both sides are sorted by the byte they start at, a running maximum of their ends is
kept, and a group ends where a start reaches that maximum. Both sides tile the same bytes, so within a group a new
overlap of one A and one B token begins at every different start.

A text is cut at single spaces between two non-blank characters. Both tokenizers start a token at each of them, so every
chunk can be coalesced on its own, chunks that were not met before are encoded together in one run, and the result of a
chunk (groups and links) is kept from one text to the next.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stocktide.llm.tokens import CUT, byte_letters, read_text
from stocktide.llm.worker import per_worker, renamed, slices_by_bytes
from stocktide.storage import staged

#: A pair of ids in one long: A's id above these bits, B's id below.
SHIFT = 20
#: Chunks a worker remembers, and chunks encoded in one run.
REMEMBERED = 500_000
RUN = 4096
#: Pairs whose counts are broadcast at most, those of the most documents first: 8 MB; the others are joined by a shuffle.
HOT_PAIRS = 1 << 18
#: How sentencepiece writes a space.
SPACE = "▁"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for lengths[i] items, all i in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


def coalesce(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and overlaps of two tilings of the same bytes, given by the byte lengths of their tokens.

    Returns the group of every A token, the group of every B token, and the overlapping pairs as indexes of A and B.
    """
    end = np.concatenate([np.cumsum(a), np.cumsum(b)])
    start = end - np.concatenate([a, b])
    order = np.lexsort((np.arange(len(start)), start))
    begins, reached = start[order], np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = begins[1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    last = np.ones(len(order), bool)
    last[:-1] = begins[1:] != begins[:-1]
    in_a = np.maximum.accumulate(np.where(order < len(a), order, 0))[last]
    in_b = np.maximum.accumulate(np.where(order >= len(a), order - len(a), 0))[last]
    return group[:len(a)], group[len(a):], in_a, in_b


class Aligner:
    """Both tokenizers with the bytes of their tokens, and what was found for the chunks met so far."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = {letter: bytes([i]) for i, letter in enumerate(byte_letters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        special = {t["content"] for t in json.loads(a_json)["added_tokens"]}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = entry.encode() if entry in special else b"".join(map(byte_of.__getitem__, entry))
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << SHIFT:
            raise ValueError("a vocabulary is too large for the pair's code")
        self.a_length, self.b_length = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        # an id and what follows it: "," within a side, "|" after the last A of a group, ";" after its last B
        self.names = [f"{i}{mark}" for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for mark in marks for i in range(n)]
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 5), np.int64)  # A tokens, B tokens, groups, where the links start, how many
        self.links = np.zeros(0, np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a space and the text; nothing where a side's bytes are not those of the text."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1) if text else []
        whole = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Coalesce chunks that are new. Those with blanks only inside are encoded together, a space before each."""
        clean = [c for c in chunks if c and not c[0].isspace() and not c[-1].isspace() and SPACE not in c]
        for at in range(0, len(clean), RUN):
            self._learn(clean[at:at + RUN])
        for chunk in set(chunks).difference(clean):
            self._learn([chunk])

    def _learn(self, chunks: list[str]) -> None:
        ids = self.encode(" ".join(chunks))
        if ids is None:
            if len(chunks) > 1:
                for chunk in chunks:
                    self._learn([chunk])
                return
            found, texts, links = np.array([[-1, 0, 0, 0, 0]]), [""], self.links[:0]
        else:
            found, texts, links = self._coalesced(chunks, *ids)
        found[:, 3] += len(self.links)
        for chunk in chunks:
            self.index[chunk] = len(self.index)
        self.groups += texts
        self.sizes = np.concatenate([self.sizes, found])
        self.links = np.concatenate([self.links, links])

    def _coalesced(self, chunks: list[str], a: np.ndarray, b: np.ndarray):
        a_length, b_length = self.a_length[a], self.b_length[b]
        a_group, b_group, in_a, in_b = coalesce(a_length, b_length)
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
        a_to, b_to = np.searchsorted(a_end, ends, "right"), np.searchsorted(b_end, ends, "right")
        link_to = np.searchsorted(in_a, a_to, "left")  # a chunk's links are those of its A tokens
        group_to = a_group[a_to - 1] + 1
        sizes = [np.diff(to, prepend=0) for to in (a_to, b_to, group_to, link_to)]
        table = np.stack([*sizes[:3], link_to - sizes[3], sizes[3]], axis=1)
        a_last = np.append(a_group[1:] != a_group[:-1], True)
        b_last = np.append(b_group[1:] != b_group[:-1], True)
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        named = np.concatenate([a + a_last * n_a, 2 * n_a + b + b_last * n_b])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        words = list(map(self.names.__getitem__, named[order].tolist()))
        to = (a_to + b_to).tolist()
        texts = ["".join(words[i:j]) for i, j in zip([0, *to], to)]
        return table, texts, (a[in_a] << SHIFT) | b[in_b]

    def texts(self, texts: list[str | None]):
        """Of each text: A tokens, B tokens, groups, the groups' text; then different pairs, how often, and their text."""
        pieces = [CUT.split(t) if t else [] for t in texts]
        new = set(chain.from_iterable(pieces)).difference(self.index)
        if new and len(self.index) + len(new) > REMEMBERED:
            self.forget()
            new = set(chain.from_iterable(pieces))
        self.learn(list(new))
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        index = np.fromiter(map(self.index.__getitem__, chain.from_iterable(pieces)), np.int64, counts.sum())
        text = np.repeat(np.arange(len(texts)), counts)
        strange = np.bincount(text, self.sizes[index, 0] < 0, len(texts)) > 0
        keep = ~strange[text]
        index, text = index[keep], text[keep]
        sizes = self.sizes[index]
        totals = [np.bincount(text, sizes[:, i], len(texts)).astype(np.int64) for i in range(3)]
        to = np.cumsum(np.bincount(text, minlength=len(texts))).tolist()
        named = index.tolist()
        groups = ["".join(map(self.groups.__getitem__, named[i:j]))[:-1] for i, j in zip([0, *to], to)]
        codes = self.links[ragged(sizes[:, 3], sizes[:, 4])] | (np.repeat(text, sizes[:, 4]) << 2 * SHIFT)
        pairs, times = np.unique(codes, return_counts=True)
        return *totals, groups, pairs & ((1 << 2 * SHIFT) - 1), times, pairs >> 2 * SHIFT


def aligned(
    docs: DataFrame, a_tokenizer: str, b_model: str, id_column: str = "doc_id", text_column: str = "text", digest: bool = False
) -> DataFrame:
    """Tokens of a space and each text by a byte-level tokenizers file (A) and a sentencepiece model (B), in groups.

    Returns doc_id, n_a, n_b, n_groups, groups (``a1,a2|b1;a3|b2,b3``; its SHA-256 where ``digest``) and links, the
    different overlapping pairs (pair = A's id * 2**20 + B's id) with their number of occurrences; one row per input
    row, without a shuffle. NULL and empty texts, and those of which one side's bytes differ from the text (a text with the
    sign that the model writes for a space), have no tokens: zeros, an empty string, no links. Repeated rows and NULL ids each
    give their own row; an empty table gives an empty result; other columns are ignored. Both files are read on the
    driver and broadcast, bounded by the vocabularies.
    """
    with open(b_model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((read_text(a_tokenizer), f.read()))
    kind = T.StructType.fromDDL(
        f"doc_id {docs.schema[id_column].dataType.simpleString()}, n_a long, n_b long, n_groups long, groups string, "
        "links array<struct<pair: long, times: int>>"
    )
    key = ("align", a_tokenizer, b_model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, schema = per_worker(key, lambda: Aligner(*shared.value)), to_arrow_schema(kind)
        links = schema.field("links").type
        for part in slices_by_bytes(batches, "text"):
            n_a, n_b, n_groups, groups, pairs, times, text = aligner.texts(part.column("text").to_pylist())
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            at = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            linked = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times.astype(np.int32))], fields=list(links.value_type))
            found = [part.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(groups, schema.field("groups").type)]
            yield pa.RecordBatch.from_arrays([*found, pa.ListArray.from_arrays(pa.array(at), linked, type=links)], schema=schema)

    return renamed(docs, doc_id=id_column, text=text_column).mapInArrow(run, kind)


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, documents, best): in how many rows of ``aligned`` each pair is linked, and whether no pair of its A id is in more."""
    counts = staged(found.select(F.inline("links")).groupBy("pair").agg(F.count("*").alias("documents")))
    highest = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("documents").alias("most"))
    best = F.broadcast(highest)  # one row per entry of A's vocabulary
    return counts.join(best, F.shiftright("pair", SHIFT) == F.col("a")).select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def with_link_counts(found: DataFrame, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Add to the rows of ``aligned``: n_links, n_best (links whose pair has its A id's highest count) and count_sum.

    Counts cover all rows. The counts of at most ``hot_pairs`` pairs, those of the most documents, are broadcast, so the bulk of the links
    is summed where it is read; links of rarer pairs, which no document count can make hot, are shuffled to theirs.
    """
    found = staged(found.withColumn("row", F.monotonically_increasing_id()))
    counts = staged(pair_counts(found))
    level = F.floor(F.log2("documents")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()  # 64 at most
    least, room = 64, hot_pairs
    for r in levels:
        if r["n"] > room:
            break
        least, room = r["level"], room - r["n"]
    links = found.select("row", F.inline("links"))
    hot = F.broadcast(counts.filter(level >= least))
    counted = links.join(hot, "pair", "inner" if least == 0 else "left")
    if least:
        rare = counts.filter(level < least)
        rest = counted.filter("documents IS NULL").select("row", "pair", "times").join(rare, "pair")
        counted = counted.filter("documents IS NOT NULL").select("row", "times", "documents", "best").unionAll(rest.select("row", "times", "documents", "best"))
    sums = counted.groupBy("row").agg(
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("documents")).alias("count_sum"),
    )
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")]
    return found.join(sums, "row", "left").select(*[c for c in found.columns if c not in ("row", "links")], *zero)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), digest=True)
    return with_link_counts(found).withColumnRenamed("groups", "groups_sha256")
