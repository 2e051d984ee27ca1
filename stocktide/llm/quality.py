"""Line-first cleaning: lines are judged by rules, failing lines go, texts that lose too much go with them.

A line fails if it is navigation (many separators between few words, or a list of menu words), boilerplate (rights,
cookies, licences, subscriptions), made of symbols, or the repetition of an earlier long line. Punctuation
is judged over the lines: short lines without a sentence end fail when hardly any line of the text has one.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from stocktide.llm.worker import map_rows, renamed

SYMBOLS = "#*$%&|<>"
NAVIGATION = frozenset("home about contact login logout register menu search sitemap help faq next previous back top share tweet".split())
BOILERPLATE = re.compile(
    r"all rights reserved|©|\bcopyright\b|cookie|privacy policy|terms of (?:use|service)|subscribe|sign up|click here"
    r"|read more|newsletter|javascript|powered by|lorem ipsum|licensed under|spdx-license|permission is hereby granted",
    re.IGNORECASE,
)
SEPARATORS = re.compile(r"[|>»·•/]")
ENDS = (".", "!", "?", "…", "。", "！", "？", ".\"", "!\"", "?\"", ":", ";")
#: A text is kept if it loses at most this share of its word characters, and at least ``LEAST`` words are left.
MOST_LOST, LEAST = 0.5, 50


def failed_lines(lines: list[str]) -> list[str | None]:
    """For each line the rule that it fails, or None; lines without a word pass, they have nothing to lose."""
    filled = [line for line in lines if line.split()]
    ended = sum(line.rstrip().endswith(ENDS) for line in filled)
    unpunctuated = len(filled) >= 5 and ended * 10 < len(filled)
    seen: set[str] = set()
    out: list[str | None] = []
    for line in lines:
        words = line.split()
        bare = line.strip()
        rule = None
        if words:
            symbols = sum(map(line.count, SYMBOLS))
            cut = len(SEPARATORS.findall(line))
            if len(words) <= 20 and (cut >= 3 and cut * 2 >= len(words) - cut or len(words) > 1 and all(w.strip(",.|>»·•").lower() in NAVIGATION for w in words)):
                rule = "navigation"
            elif len(words) <= 40 and BOILERPLATE.search(line):
                rule = "boilerplate"
            elif symbols * 4 > sum(map(len, words)):
                rule = "symbols"
            elif bare in seen and len(bare) >= 20:
                rule = "repeated"
            elif unpunctuated and len(words) < 6 and not bare.endswith(ENDS):
                rule = "punctuation"
            seen.add(bare)
        out.append(rule)
    return out


def words_of(text: str) -> list[bytes]:
    """Words are runs of anything but ASCII blanks."""
    return text.encode().split()


def judged(text: str | None, most_lost: float = MOST_LOST, least: int = LEAST) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lines_failed, cleaned."""
    text = text or ""
    words, lines = words_of(text), text.split("\n")
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\r\x0b\x0c"))
    symbols = sum(map(text.count, SYMBOLS))
    filled = Counter(line for line in lines if line.strip(" \t\n\r\x0b\x0c"))
    repeated_lines = sum(c - 1 for c in filled.values())
    repeated = repeated_words(words)
    base_failed = n < 50 or 100 * repeated > 50 * n
    rules = failed_lines(lines)
    cleaned = "\n".join(line for line, rule in zip(lines, rules) if rule is None)
    left = words_of(cleaned)
    kept = not base_failed and len(left) >= least and sum(map(len, left)) >= (1 - most_lost) * sum(map(len, words))
    return n, chars, symbols, repeated_lines, repeated, base_failed, kept, sum(r is not None for r in rules), cleaned


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words that the text has twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    total = until = 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + size - max(i, until)
            until = i + size
    return total


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, lines_failed long, cleaned string"
)


def line_first_cleaning(
    docs: DataFrame, most_lost: float = MOST_LOST, least: int = LEAST,
    id_column: str = "doc_id", text_column: str = "text", cleaned: bool = True,
) -> DataFrame:
    """One row per input row with the counts, the verdict and, if asked, the cleaned text; no shuffle.

    NULL counts as the empty text (no words, base_failed). Repeated rows and NULL ids each give their own row; an
    empty table gives an empty result; other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    fields = FIELDS if cleaned else FIELDS.rpartition(", ")[0]
    n = fields.count(",") + 1

    def start():
        return lambda ids, texts: (ids, *list(zip(*(judged(t, most_lost, least) for t in texts)))[:n])

    return map_rows(renamed(docs, doc_id=id_column, text=text_column), ["doc_id", "text"], f"doc_id {kind}, {fields}", start)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first_cleaning(spark.read.parquet(f"{sf_dir}/documents.parquet"), cleaned=False)
