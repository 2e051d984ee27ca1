"""Token counts, byte BPE, quality rules, language and toxicity against libraries, brute force and held-out rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stocktide.llm import byte_bpe, language, quality, subword, tokens, toxicity, worker

ODD = [
    None, "", "  ", "a", "  a  b\n\n c <|endoftext|> d", "<|endoftext|>", " don't I'LL 12 3,4 ... é́ \U0001f600 漢字 \x1c b \x85c",
    "\n \n a", "ʼn't ²³ Ⅷ ½ ٣", "x" * 5000, "thtion and " * 900, "a b  c",
]
DOCS = "doc_id long, text string, n_tokens string, ids string"


def odd_docs(spark):
    rows = [(i, t, "x", None) for i, t in enumerate(ODD)] + [(None, "null id", "x", None), (3, "a", "x", None), (3, "a", "x", None)]
    return spark.createDataFrame(rows, DOCS), rows


def by_text(found, docs_rows, column):
    """Rows come back as many as went in; compare as bags of (id, value)."""
    return Counter((r["doc_id"], r[column]) for r in found)


@pytest.fixture(scope="module")
def counter():
    spec = tokens.read_text(P.path("byte_bpe_50k.json"))
    return tokens.TokenCounter(spec, tokens.whole_tokens(spec))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab T'snt\n\t 1.é"), st.characters(codec="utf-8")), max_size=40))
def test_counts_as_the_library(counter, text):
    assert counter.count(text) == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)


def test_whole_tokens_are_one_token_each(counter):
    some = sorted(counter.whole)[::997]
    assert len(counter.whole) > 40_000 and all(counter.by_library(s) == 1 for s in some)


def test_token_counts_of_odd_rows(spark, counter):
    docs, rows = odd_docs(spark)
    found = tokens.token_counts(docs, P.path("byte_bpe_50k.json")).collect()
    assert by_text(found, rows, "n_tokens") == Counter((i, counter.by_library(t or "")) for i, t, *_ in rows)
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in found)
    assert {r["doc_id"]: r["n_bytes"] for r in found}[6] == len(ODD[6].encode())
    assert tokens.token_counts(docs.limit(0), P.path("byte_bpe_50k.json")).collect() == []


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.TextEncoder(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=encoder.bpe.ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab T'snt\n\t 1.é"), st.characters(codec="utf-8")), max_size=40))
def test_encodes_and_decodes_as_the_library(encoder, library, text):
    ids = encoder.encode(text)
    assert ids == library.encode_ordinary(text) and encoder.bpe.decode(ids) == text.encode()


def test_a_word_is_encoded_once_whatever_marks_follow_it(library):
    class Counted:
        def __init__(self, ends):
            self.ends, self.letters = ends, 0

        def iter(self, letters):
            self.letters += len(letters)
            return self.ends.iter(letters)

    fresh = byte_bpe.TextEncoder(byte_bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)
    fresh.bpe.ends = ends = Counted(fresh.bpe.ends)
    words = [f"heshbl{a}{b}éwh" for a in "aeiou" for b in "bcdfg"]
    text = " ".join(w + marks for w in words for marks in ("", ",", ".", "!!", "###", "...", "'s", ".\nOf", "'"))
    assert fresh.encode(text) == library.encode_ordinary(text)
    assert ends.letters < 3 * len(" ".join(words).encode())  # the first piece, the words and the marks; nine times the words before


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=12), max_size=6))
def test_strings_side_by_side_are_encoded_as_each_alone(encoder, strings):
    bpe = encoder.bpe
    assert bpe.encode_all([s.decode("latin-1") for s in strings]) == [bpe.merged(s) if s else [] for s in strings]


@settings(max_examples=80, deadline=None)
@given(st.binary(min_size=1, max_size=60), st.data())
def test_prefix_tables_append_and_edit(encoder, data, draw):
    bpe = encoder.bpe
    assert bpe.read(data, bpe.table(data)) == bpe.merged(data)
    cut = draw.draw(st.integers(0, len(data)))
    assert bpe.table(data, bpe.table(data[:cut])) == bpe.table(data)
    start, stop = sorted(draw.draw(st.tuples(st.integers(0, len(data)), st.integers(0, len(data)))))
    new = draw.draw(st.binary(max_size=6))
    changed, table = bpe.edited(data * 4, bpe.table(data * 4), start, stop, new)
    assert changed == data[:start] + new + (data * 4)[stop:] and table == bpe.table(changed)


def test_byte_bpe_of_odd_rows(spark, library):
    docs, rows = odd_docs(spark)
    found = byte_bpe.byte_bpe(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    want = Counter((i, hashlib.sha256(" ".join(map(str, library.encode_ordinary(t or ""))).encode()).hexdigest()) for i, t, *_ in rows)
    assert by_text(found, rows, "ids_sha256") == want
    assert by_text(found, rows, "decoded_sha256") == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert all(len(r["ids"]) == r["n_tokens"] for r in found)
    assert byte_bpe.byte_bpe(docs.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    marked = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked),
        len(words) < 50 or 100 * len(marked) > 50 * len(words),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|\n\té\x0b\x1c", max_size=200))
def test_base_counts(text):
    assert quality.judged(text)[:6] == plain_base(text)


def test_quality_of_odd_rows_and_lines(spark):
    docs, rows = odd_docs(spark)
    found = quality.line_first_cleaning(docs).collect()
    assert by_text(found, rows, "n_words") == Counter((i, plain_base(t)[0]) for i, t, *_ in rows)
    assert quality.line_first_cleaning(docs.limit(0)).collect() == []
    prose = "\n".join(" ".join(f"w{i * 37 % 101}x{j * i}" for j in range(9)) + "." for i in range(1, 13))
    menu = "Home | About | Contact | Login\nAll rights reserved. Copyright 2020\n"
    judged = quality.judged(menu + prose)
    assert judged[6] and judged[7] == 2 and judged[8] == prose
    noise = "\n".join("### *** %%% $$$ &&& word" + str(i) for i in range(60))
    assert not quality.judged(noise + "\n" + prose)[6]


def test_queries_equal_brute_force_on_documents(spark, sf_dir, counter, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = tokens.op1_token_counts(spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: counter.by_library(t) for i, t in texts.items()}
    found = byte_bpe.op5_byte_bpe(spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: len(library.encode_ordinary(t)) for i, t in texts.items()}
    found = quality.op7_quality_rules(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r)[1:7] for r in found} == {i: plain_base(t) for i, t in texts.items()}
    assert all(not r["kept"] for r in found if r["base_failed"])


def labelled(spark, n=400):
    random = np.random.default_rng(1)
    syllables = ["ta", "ri", "mo", "ne", "lu", "ska", "per", "in"]
    make = lambda k: " ".join("".join(random.choice(syllables, 3)) for _ in range(k))
    docs, labels = [], []
    for i in range(n):
        text, bad = make(60), i % 5 == 0
        if bad:
            text += " you wretched scoundrel " + make(40)
        docs.append((i, text, "de" if i % 2 else "en", "s", "toxic"))
        labels.append((i, int(bad), int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score string"), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_toxicity_held_out_and_misspelt(spark):
    docs, labels = labelled(spark)
    extra = spark.createDataFrame(
        [(9001, "wretchedd scoundrell", None, None, None), (9002, None, None, None, None), (9003, "", None, None, None), (None, "taritari", None, None, None)],
        docs.schema,
    )
    found = toxicity.toxicity(docs.unionAll(extra), labels).collect()
    by_id = {r["doc_id"]: r for r in found}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(by_id[i]["held_out"] == (i in held) for i in range(400))
    wrong = [i for i in held if by_id[i]["predicted"] != (i % 5 == 0)]
    assert len(wrong) <= 0.05 * len(held)
    assert by_id[9001]["predicted"] == 1 and by_id[9002]["score"] == by_id[9003]["score"] and not by_id[None]["held_out"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)
    kept = toxicity.without_toxic(docs.unionAll(extra), labels)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(r["doc_id"]) for r in found if not r["predicted"])
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []
    none = toxicity.toxicity(docs.limit(5), labels.limit(0)).collect()
    assert len(none) == 5 and all(r["score"] < 1e-6 for r in none)


def test_worst_span_may_start_at_any_word(spark):
    shares = np.zeros(80)
    shares[12:36] = 1  # on both sides of the border at 24
    assert toxicity.worst_at(shares, 24) == (12, 1.0)
    docs, labels = labelled(spark, 120)
    marks = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [(r["text"], marks[r["doc_id"]]) for r in docs.orderBy("doc_id").collect()]
    score = toxicity.fit_toxicity(rows).scorer()
    for text, _ in rows:
        found = toxicity.distinct(text)
        starts = range(max(1, len(found) - toxicity.SPAN + 1))
        assert score(text) == pytest.approx(max(score(" ".join(found[a:a + toxicity.SPAN])) for a in starts), abs=1e-6)


def test_toxicity_never_learns_held_out_labels(spark):
    docs, labels = labelled(spark, 120)
    changed = labels.withColumn("toxic", F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2, 1).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, changed).collect()}
    assert a == b


def test_language_of_documents_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = {r["doc_id"]: r for r in language.op4_language(spark, sf_dir).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in found.items() if r["held_out"]} == set(held)
    assert sum(found[i]["lang_pred"] == truth[i] for i in held) >= 0.95 * len(held)
    odd, rows = odd_docs(spark)
    odd = odd.withColumn("lang", F.lit(None).cast("string")).withColumn("score", F.lit("x"))
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in language.language(odd).collect())
    both = language.language(odd.select("doc_id", "text", "lang").unionAll(docs.select("doc_id", "text", "lang")), rejecting=False)
    named = Counter((r["doc_id"], r["lang_pred"] == "und") for r in both.collect())
    assert named[(None, False)] == 1 and language.language(odd.limit(0)).collect() == []


def test_subwords_by_hand():
    rows, of = subword.subwords(["abc", "", "é"], 1 << 18, (3, 4, 5))
    assert Counter(of.tolist()) == {0: 3 + 2 + 1 + 1, 2: 1 + 1}  # n-grams of <abc> and of <é>, and the words
    again, _ = subword.subwords(["abc"], 1 << 18, (3, 4, 5))
    assert sorted(rows[of == 0].tolist()) == sorted(again.tolist())


def test_subwords_of_training_texts_take_little_more_than_their_rows():
    texts = [[f"{i:x}{j * 7919:06x}" for j in range(300)] for i in range(200)]
    tracemalloc.start()
    try:
        data = subword.Spans.of(iter(texts), 1 << 18, (3, 4, 5))
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(data.starts) == 200 * 300 + 1
    assert peak < 8 * 4 * len(data.rows)  # all words at once took over 60 bytes a row
    found, of = subword.subwords([w for t in texts[-2:] for w in t], 1 << 18, (3, 4, 5))
    assert data.rows[data.starts[-601]:].tolist() == found[np.argsort(of, kind="stable")].tolist()


def test_a_worker_lets_go_of_what_another_step_kept(monkeypatch):
    task, made = [-1], []
    monkeypatch.setattr(worker, "_task", lambda: task[0])
    keep = lambda key: worker.per_worker(key, lambda: made.append(key) or key)
    for task[0], key in [(-1, "a"), (-2, "a"), (-3, "b"), (-4, "a")]:
        assert keep(key) == key
        worker.release()
    assert made == ["a", "b", "a"]  # kept from one task to the next, but not beside another step's
    task[0] = -5
    worker.release()
    assert not worker._held()
