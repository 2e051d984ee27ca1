"""Token counts of whole texts by a byte-level BPE tokenizer, with a whole-token shortcut.

A vocabulary string that encodes alone as exactly one token is one token wherever it stands as a pre-token, because
merges never cross pre-tokens. Which strings do so is proved once, on the driver, by encoding each of them. Pre-tokens
found in that set count 1 without any merge; only the rest is merged by the tokenizer's own model.

A text is cut at single spaces between two non-blank characters: the split pattern starts a new pre-token at each of
them, so the pieces are independent and their counts can be kept from one text to the next.
"""

from __future__ import annotations

import json
import re

import regex
from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.worker import Bounded, map_rows, per_worker, renamed

#: The split of byte-level BPE (fixed value, the tokenizer file names it by ``use_regex``).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Beyond these characters, Unicode tables of different libraries may differ: the tokenizer itself counts the piece.
COMMON = re.compile("[\x00-ɏ‐-‧]*")
#: Pieces a worker remembers.
REMEMBERED = 600_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, others from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in shown}
    letters |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}
    return [letters[b] for b in range(256)]


def whole_tokens(tokenizer_json: str) -> frozenset[str]:
    """The vocabulary strings proved to encode alone as one token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    strings = []
    for entry in json.loads(tokenizer_json)["model"]["vocab"]:
        try:
            strings.append(bytes(byte_of[c] for c in entry).decode())
        except (KeyError, UnicodeDecodeError):  # half a character is never a pre-token
            continue
    encoded = tokenizer.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1)


class TokenCounter:
    """Counts tokens of texts exactly as the tokenizer does, special strings inside texts included."""

    def __init__(self, tokenizer_json: str, whole: frozenset[str]):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("the shortcut needs a byte-level tokenizer without normalizer and prefix space")
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.whole, self.split = whole, regex.compile(PATTERN).findall
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.known = Bounded(REMEMBERED)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return self.by_library(text)
        pieces = CUT.split(text)
        first, known = self.piece(pieces.pop(0)), self.known
        known.room_for(len(pieces))
        for piece in set(pieces):
            if piece not in known:
                known[piece] = self.piece(" " + piece)
        return first + sum(map(known.__getitem__, pieces))

    def piece(self, text: str) -> int:
        if text in self.whole:
            return 1
        if not COMMON.fullmatch(text):
            return self.by_library(text)
        return sum(1 if p in self.whole else self.merged(p) for p in self.split(text))

    def merged(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token.encode().decode("latin-1").translate(self.letters)))

    def by_library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def read_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Bytes and tokens of every text, one row per input row, without a shuffle.

    ``tokenizer`` is the path of a tokenizers file on the driver; its content and the proved strings (both bounded by
    the vocabulary) travel to the workers. NULL counts as the empty text: 0 bytes, 0 tokens. Repeated rows and NULL
    ids each give their own row; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    spec = read_text(tokenizer)
    shared = spark.sparkContext.broadcast((spec, whole_tokens(spec)))

    def start():
        counter = per_worker(("token_counts", hash(shared.value[0])), lambda: TokenCounter(*shared.value))

        def count(ids, texts):
            found = [counter.count(t) for t in texts]
            return ids, [len(t.encode()) if t else 0 for t in texts], found, [n > limit for n in found]

        return count

    kind = docs.schema[id_column].dataType.simpleString()
    return map_rows(
        renamed(docs, doc_id=id_column, text=text_column), ["doc_id", "text"],
        f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", start,
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
