"""Averaged subword embeddings under a linear softmax, trained jointly by stochastic gradient descent in numpy.

A word is the bag of its character n-grams and itself, hashed into a fixed number of rows; a span of words is the mean
of its words' means. Words that were never seen share the vectors of their n-grams. Because everything up to the
softmax is linear, a trained model gives every word its own share of the logits, which workers remember by word.
"""

from __future__ import annotations

import string
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from stocktide.llm.worker import Bounded

#: Longer runs without a blank are cut, so that texts without blanks still have words.
LONGEST = 40
#: Words a worker remembers.
REMEMBERED = 400_000
#: Words whose subwords are worked on together in training: about 3 MB for each array that this takes.
AT_ONCE = 1 << 14
PUNCTUATION = string.punctuation + "¡¿«»“”„‘’‚–—…·"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
POWERS = np.cumprod(np.full(2 * LONGEST, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


def words(text: str | None) -> list[str]:
    """Whole text in lower case, split at blanks, without punctuation around the words; some may be empty then."""
    found = text.lower().split() if text else []
    if found and max(map(len, found)) > LONGEST:
        found = [w[i:i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return [w.strip(PUNCTUATION) for w in found]


def spread(found: list[str], span: int, most: int) -> str:
    """Words as a text that has the same words: all of them, or of more than ``most`` spans so many, spread evenly."""
    starts = range(0, len(found), span)
    if len(starts) > most:
        found = [w for j in np.linspace(0, len(starts) - 1, most).astype(int).tolist() for w in found[starts[j]:starts[j] + span]]
    return " ".join(w or "." for w in found)


def subwords(found: list[str], rows: int, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed rows of the n-grams of all words, their ends marked, and of the words themselves, and each row's word.

    An empty word has none. The hashes are polynomials over code points, computed for all words at once.
    """
    marked = [f"<{w}>" if w else "" for w in found]
    code = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(np.uint64)
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    word = np.repeat(np.arange(len(marked)), n)
    ends = np.cumsum(n)
    left = np.repeat(ends, n) - np.arange(len(code))
    at = n[word] - left
    hashes, of = [], []
    rolled = np.zeros(len(code), np.uint64)
    for size in range(1, max(sizes) + 1):
        if size > len(code):
            break
        rolled = rolled[:len(code) - size + 1] * MULTIPLIER + code[size - 1:]
        if size in sizes:
            inside = np.flatnonzero(left[:len(rolled)] >= size)
            hashes.append(rolled[inside] + np.uint64(size))
            of.append(word[inside])
    if len(code):
        filled = np.flatnonzero(n)
        hashes.append(np.add.reduceat(code * POWERS[at], (ends - n)[filled]))
        of.append(filled)
    mixed = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(rows)).astype(np.int64), np.concatenate([*of, np.zeros(0, np.int64)])


@dataclass
class Spans:
    """Spans of words as indexes into a list of different words, with those words' subword rows."""

    rows: np.ndarray  # of all words, one after the other
    starts: np.ndarray  # where each word's rows start, and the end
    spans: list[np.ndarray]

    @staticmethod
    def of(texts: Iterable[list[str]], rows: int, sizes: tuple[int, ...]) -> "Spans":
        index: dict[str, int] = {}
        spans = [np.array([index.setdefault(w, len(index)) for w in t], np.int32) for t in texts]
        words, parts, counts = list(index), [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for at in range(0, len(words), AT_ONCE):
            some = words[at:at + AT_ONCE]
            found, of = subwords(some, rows, sizes)
            parts.append(found.astype(np.int32)[np.argsort(of, kind="stable")])
            counts.append(np.bincount(of, minlength=len(some)))
        return Spans(np.concatenate(parts), np.cumsum(np.concatenate(counts)), spans)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for lengths[i] items, all i in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - starts, lengths)


class SubwordSoftmax:
    def __init__(self, classes: int, rows: int = 1 << 18, width: int = 8, sizes: tuple[int, ...] = (3, 4, 5), floor: int = 1, seed: int = 7):
        random = np.random.default_rng(seed)
        self.floor = floor  # a shorter span is averaged as if filled up with words that say nothing
        self.classes, self.rows, self.sizes = classes, rows, sizes
        self.vectors = random.normal(0, 0.01, (rows, width))  # an n-gram never seen adds next to nothing
        self.weights = random.normal(0, 0.5, (width, classes))
        self.bias = np.zeros(classes)
        self._seen = [np.full(rows, 1e-8), np.full((width, classes), 1e-8), np.full(classes, 1e-8)]

    def word_logits(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Share of each word in the logits (without bias); 0 for words without subwords."""
        n = np.diff(starts)
        share = np.zeros((len(n), self.classes))
        if len(rows):
            by_row = self.vectors @ self.weights
            filled = np.flatnonzero(n)
            for at in range(0, len(filled), AT_ONCE):
                some = filled[at:at + AT_ONCE]
                first, end = starts[some[0]], starts[some[-1] + 1]
                share[some] = np.add.reduceat(by_row[rows[first:end]], starts[some] - first, axis=0) / n[some, None]
        return share

    def step(self, data: Spans, chosen: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One step of AdaGrad on the cross entropy of the chosen spans."""
        size = np.array([len(data.spans[i]) for i in chosen])
        chosen, labels, size = chosen[size > 0], labels[size > 0], size[size > 0]
        if not len(chosen):
            return
        word = np.concatenate([data.spans[i] for i in chosen])
        span = np.repeat(np.arange(len(chosen)), size)
        n = data.starts[word + 1] - data.starts[word]
        row = data.rows[_ragged(data.starts[word], n)]
        share = np.repeat(1 / np.maximum(n, 1) / np.maximum(size, self.floor)[span], n)
        of = np.repeat(span, n)
        width = self.vectors.shape[1]
        mean = np.stack([np.bincount(of, share * self.vectors[row, d], len(chosen)) for d in range(width)], 1)
        p = softmax(mean @ self.weights + self.bias)
        p[np.arange(len(chosen)), labels] -= 1
        p /= len(chosen)
        up = p @ self.weights.T
        used, place = np.unique(row, return_inverse=True)
        grad = np.stack([np.bincount(place, share * up[of, d], len(used)) for d in range(width)], 1)
        g_weights, g_bias = mean.T @ p, p.sum(0)
        self._seen[0][used] += (grad**2).mean(1)
        self.vectors[used] -= rate * grad / np.sqrt(self._seen[0][used])[:, None]
        for value, g, seen in ((self.weights, g_weights, self._seen[1]), (self.bias, g_bias, self._seen[2])):
            seen += g**2
            value -= rate * g / np.sqrt(seen)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class WordScores:
    """Logit shares of the words of a text, remembered by word; holds only the product of vectors and weights."""

    def __init__(self, model: "Trained"):
        self.model = model
        self.known = Bounded(REMEMBERED)
        self.table = np.zeros((REMEMBERED + 1, model.by_row.shape[1]), np.float32)

    def of(self, found: list[str]) -> np.ndarray:
        known = self.known
        if len(found) > REMEMBERED:  # a very long text, part by part
            half = len(found) // 2
            return np.concatenate([self.of(found[:half]), self.of(found[half:])])
        known.room_for(len(found))
        new = [w for w in set(found) if w not in known]
        if new:
            first, (rows, of) = len(known), subwords(new, len(self.model.by_row), self.model.sizes)
            n = np.maximum(np.bincount(of, minlength=len(new)), 1)
            for k in range(self.table.shape[1]):
                self.table[first:first + len(new), k] = np.bincount(of, self.model.by_row[rows, k], len(new)) / n
            known.update(zip(new, range(first, first + len(new))))
        return self.table[np.fromiter(map(known.__getitem__, found), np.int64, len(found))]


@dataclass
class Trained:
    """What workers need: ``by_row`` is the logits' share of each hashed row, a table of fixed size."""

    by_row: np.ndarray
    bias: np.ndarray
    sizes: tuple[int, ...]

    @staticmethod
    def of(model: SubwordSoftmax) -> "Trained":
        return Trained((model.vectors @ model.weights).astype(np.float32), model.bias.copy(), model.sizes)
