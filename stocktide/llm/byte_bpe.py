"""Byte-level BPE by dynamic programming over prefixes, with exact appends and edits, and decoding.

Two facts carry it. A row of tokens is the encoding of its bytes exactly when each pair of neighbours is, alone, the
encoding of its own bytes. And every prefix of a byte string has exactly one valid last token. So one pass stores, for
each prefix, its last token: the longest-to-shortest tokens that end there are tried until one is compatible with the
last token of the prefix in front of it. The encoding is read by walking back.
More bytes extend the table without touching it, and after an edit only the prefixes from the edit on are done again,
until they agree with the old table over the length of the longest token.
"""

from __future__ import annotations

import base64
import hashlib
import re
from itertools import chain, filterfalse

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.tokens import CUT
from stocktide.llm.worker import Bounded, map_rows, per_worker, renamed

#: Pieces of text, and pairs of tokens, that a worker remembers.
REMEMBERED = 600_000
#: Stands for the token in front of the first one.
START = -2
#: A letter that stands for no byte.
BORDER = "\u0100"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.size_of = {rank: len(token) for token, rank in ranks.items()}
        #: For each token what is known of which tokens it may follow; START is the start of the bytes.
        self.follows: dict[int, dict[int, bool]] = {rank: {} for rank in self.bytes_of}
        self.pairs = 0
        #: Finds all tokens that end at each byte, longest first.
        self.ends = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.ends.add_word(token.decode("latin-1"), (len(token), rank, self.follows[rank]))
        self.ends.make_automaton()
        self.alone = Bounded(REMEMBERED)
        self.split_of = Bounded(REMEMBERED)
        self.rank_of_text = {token.decode(): rank for token, rank in ranks.items() if token.isascii()}

    def merged(self, data: bytes, below: int = 1 << 40) -> list[int]:
        """Encoding of a few bytes by merging the lowest rank first, by ranks below a limit only; the definition that
        compatibility rests on."""
        parts, ranks = [data[i:i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if ranks.get(parts[best] + parts[best + 1], below) >= below:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return [ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; none for a single byte or a token that merging never makes."""
        known = self.split_of.get(token, 0)
        if known == 0:
            self.split_of.room_for(1)
            parts = self.merged(self.bytes_of[token], token)
            known = self.split_of[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay apart: no merge across their border comes before the merges that make them.

        Walks back in time: the later of both tokens is taken apart, which leaves its half at the border, until both sides are
        single bytes. A merge of the two halves at the border with a rank below the one just undone would have come first.
        """
        fits, l, r, undone = True, left, right, 1 << 40
        while True:
            across = self.ranks.get(self.bytes_of[l] + self.bytes_of[r])
            if across is not None and across < undone:
                fits = False
                break
            inner_l, inner_r = self.halves(l), self.halves(r)
            # of equal tokens the left one is made first
            if inner_l and (not inner_r or l > r):
                undone, l = l, inner_l[1]
            elif inner_r:
                undone, r = r + 1, inner_r[0]
            else:
                break
        return fits

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``, or START; remembered. Nothing follows bytes that have no token."""
        if left == -1:
            return False
        if self.pairs >= REMEMBERED:
            for known in self.follows.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        fits = self.follows[right][left] = self.stands_alone(right) if left == START else self.compatible(left, right)
        return fits

    def stands_alone(self, token: int) -> bool:
        known = self.alone.get(token)
        if known is None:
            self.alone.room_for(1)
            known = self.alone[token] = self.merged(self.bytes_of[token]) == [token]
        return known

    def table(self, data: bytes, last: list[int] | None = None) -> list[int]:
        """Last tokens of all prefixes; a table of the first bytes is extended in place (an exact append)."""
        last = [-1] if last is None else last
        self.extend(data, last)
        return last

    def extend(self, data: bytes, last: list[int], agree: list[int] | None = None, stop: int = 0) -> None:
        """Append the unique valid last token of each further prefix.

        With a table of the text before an edit that ended at ``stop`` there, work ends where both agree for a longest token.
        """
        start, may_follow = len(last) - 1, self.may_follow
        base = max(0, start - self.longest + 1)
        size = len(data)
        last.extend([-1] * (size - start))
        shift, same = (size - (len(agree) - 1) if agree else 0), 0
        for at, (n, token, known) in self.ends.iter(data[base:].decode("latin-1")):
            end = base + at + 1
            if last[end] >= 0 or end <= start:
                continue
            before = last[end - n] if n < end else START
            fits = known.get(before)
            if fits is None:
                fits = may_follow(before, token)
            if fits:
                last[end] = token
                if agree is not None:
                    old = end - shift
                    same = same + 1 if old > stop and agree[old] == token else 0
                    if same >= self.longest:
                        last[end:] = agree[old:]
                        return

    def edited(self, data: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace ``data[start:stop]`` and mend the table; work stops where old and new agree for a longest token."""
        changed, fresh = data[:start] + new + data[stop:], last[:start + 1]
        self.extend(changed, fresh, agree=last, stop=stop)
        return changed, fresh

    def read(self, data: bytes, last: list[int]) -> list[int]:
        """Walk back from the end."""
        ids, at = [], len(data)
        while at:
            if last[at] < 0:
                raise ValueError("a byte is missing from the vocabulary")
            ids.append(last[at])
            at -= self.size_of[last[at]]
        return ids[::-1]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pre-token. One that is in the vocabulary is that token, as the library has it."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.encode_all([data.decode("latin-1")])[0]

    def encode_text(self, text: str) -> list[int]:
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        """Ids of pre-tokens. Those in the vocabulary are that token, the others' tables are made in one pass."""
        whole = self.ranks.get
        encoded = [t if t.isascii() else t.encode().decode("latin-1") for t in texts]
        entries = [self.rank_of_text.get(t) if t.isascii() else whole(t.encode()) for t in texts]
        found = iter(self.encode_all([t for t, entry in zip(encoded, entries) if entry is None]))
        return [next(found) if entry is None else [entry] for entry in entries]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """``table`` and ``read`` of strings of bytes, each byte given as a letter, side by side with a letter between them that is no byte."""
        letters, out, at = BORDER.join(texts), [], 0
        last = [-1] * (len(letters) + 1)
        for text in texts:
            last[at] = START
            at += len(text) + 1
        for at, (n, token, known) in self.ends.iter(letters):
            if last[at + 1] == -1:
                before = last[at + 1 - n]
                fits = known.get(before)
                if fits is None:
                    fits = self.may_follow(before, token)
                if fits:
                    last[at + 1] = token
        end, size_of = -1, self.size_of
        for text in texts:
            end += len(text) + 1
            ids, at = [], end
            while (token := last[at]) != START:
                if token < 0:
                    raise ValueError("a byte is missing from the vocabulary")
                ids.append(token)
                at -= size_of[token]
            out.append(ids[::-1])
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


#: Letters that all Unicode tables agree on, and marks of which a run is one pre-token behind letters, before a blank.
COMMON = re.compile("[a-zA-ZÀ-ÖØ-öø-ɏ]+")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

Piece = tuple[tuple[int, ...], str, bytes]


class TextEncoder:
    """Whole texts: each match of the pattern on its own; of pieces between single spaces the ids, their digits and bytes are remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.bpe, self.split = PrefixBpe(ranks), regex.compile(pattern).findall
        #: Pieces without a blank at either end, as they stand behind a space.
        self.known = Bounded(REMEMBERED)
        self.marks = Bounded(10_000)
        self.digits_of = {rank: str(rank) for rank in self.bpe.bytes_of}

    def piece(self, text: str) -> Piece:
        """Ids, their decimal digits, and the bytes that they decode to."""
        known, ids = self.known.get, []
        for match in self.split(text):
            found = known(match[1:]) if match[0] == " " else None
            ids += found[0] if found else self.bpe.encode_text(match)
        return self._made(ids)

    def remember(self, new: set[str]) -> None:
        """Pieces that stand behind a space. A word needs no pattern, nor do marks at its end; it is remembered without them too."""
        known, others, marked, words = self.known, [], [], []
        for piece in new:
            word = piece.rstrip(MARKS)
            if not COMMON.fullmatch(word):
                others.append(piece)
                continue
            if len(word) < len(piece):
                marked.append((piece, word))
            if word not in known:
                words.append(word)
        words = list(dict.fromkeys(words))
        for word, ids in zip(words, self.bpe.encode_texts([" " + w for w in words])):
            known[word] = self._made(ids)
        for piece, word in marked:
            (ids, digits, data), (more, more_digits, more_data) = known[word], self._marks(piece[len(word):])
            known[piece] = ids + more, f"{digits} {more_digits}", data + more_data
        for piece in others:
            known[piece] = self.piece(" " + piece)

    def _marks(self, text: str) -> Piece:
        found = self.marks.get(text)
        if found is None:
            self.marks.room_for(1)
            found = self.marks[text] = self._made(self.bpe.encode_text(text))
        return found

    def _made(self, ids: list[int]) -> Piece:
        return tuple(ids), " ".join(map(self.digits_of.__getitem__, ids)), self.bpe.decode(ids)

    def pieces(self, text: str) -> tuple[list[str], set[str]]:
        """The text cut at single spaces between two non-blank characters, where the pattern starts a new match; and those not remembered.

        Cutting at every space is right unless a piece is empty or has a blank at an end. No such piece is remembered, so only new ones
        need to be looked at.
        """
        found, known = text.split(" "), self.known.__contains__
        new = set(filterfalse(known, found[1:]))
        if len(found) > 1 and (not found[0] or found[0][-1].isspace() or any(not p or p[0].isspace() or p[-1].isspace() for p in new)):
            found = CUT.split(text)
            new = set(filterfalse(known, found[1:]))
        return found, new

    def parts(self, text: str | None) -> list[Piece]:
        """What ``piece`` gives for the pieces of a text, one after the other."""
        if not text:
            return []
        (first, *pieces), new = self.pieces(text)
        known, out = self.known, [self.piece(first)]
        if len(known) + 2 * len(new) > known.limit:  # a new piece may bring its word without marks
            known.clear()
            new = set(pieces)
        self.remember(new)
        out.extend(map(known.__getitem__, pieces))
        if pieces and pieces[-1][-1].isspace():
            del known[pieces[-1]]
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(ids for ids, _, _ in self.parts(text)))


def byte_bpe(
    docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", ids: bool = True
) -> DataFrame:
    """Encode every text, then decode the ids; one row per input row, without a shuffle.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and, unless ``ids`` is false, the ids and the decoded bytes.
    ``pattern`` must split at single spaces between non-blank characters, as those of byte-level BPE do. NULL counts
    as the empty text (no ids; digests of nothing). Repeated rows and NULL ids each give their own row; an empty
    table gives an empty result; other columns are ignored.
    """
    table = read_ranks(ranks)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # bounded by the vocabulary
    key = ("byte_bpe", ranks, pattern, len(table))

    def start():
        encoder = per_worker(key, lambda: TextEncoder(shared.value, pattern))

        def encode(doc_ids, texts):
            out = [doc_ids, [], [], [], [], []]
            for text in texts:
                numbers, digits, decoded = zip(*encoder.parts(text)) if text else ((), (), ())
                found = b"".join(decoded)
                digest = hashlib.sha256(" ".join(digits).encode()).hexdigest()
                values = (sum(map(len, numbers)), digest, hashlib.sha256(found).hexdigest())
                for held, v in zip(out[1:], (*values, *((list(chain.from_iterable(numbers)), found) if ids else ()))):
                    held.append(v)
            return out if ids else out[:4]

        return encode

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * ids
    return map_rows(renamed(docs, doc_id=id_column, text=text_column), ["doc_id", "text"], schema, start)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False,
    )
