"""Clashing column names, repeated rows, and scores recomputed word by word."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stocktide.llm import exact_dedup, language, subword, suffix_dedup, toxicity


def test_added_columns_cannot_clash_in_the_suffix_stage(spark):
    shared = "".join(chr(97 + i * i % 26) for i in range(260))
    rows = [(i, f"{i} own words {shared} end {i}", "s", "t", i, "k", 1, "w") for i in range(3)] + [(9, None, "s", "t", 9, "k", 1, "w"), (None, "x", "s", "t", 0, "k", 1, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, text2 string, row long, key string, n_chars int, c0 string")
    out = suffix_dedup.without_repeated_strings(docs)
    assert out.columns == docs.columns
    found = {r["doc_id"]: r for r in out.collect()}
    assert found[1]["text"] == "11" and found[1]["row"] == 1  # what is between is in all three
    assert found[9]["text"] is None and found[None]["text"] == "x" and found[1]["n_chars"] == len(found[1]["text"])


def test_of_rows_that_repeat_id_and_text_the_same_one_stays(spark):
    rows = [(1, "Same", f"v{i}") for i in range(6)] + [(1, "sAME", "w"), (0, "same", "x"), (2, "other", "y")]
    kept = []
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string").repartition(3, "lang")
        kept.append(sorted(map(tuple, exact_dedup.without_copies(docs).collect())))
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2


def test_toxicity_scores_word_by_word(spark, sf_dir, monkeypatch):
    models = []
    train = toxicity.trained_model
    monkeypatch.setattr(toxicity, "trained_model", lambda *a: models.append(train(*a)) or models[-1])
    found = {r["doc_id"]: r for r in toxicity.op2_toxicity(spark, sf_dir).collect()}
    model, texts = models[0], {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(found) == sorted(texts)
    scores, bias = subword.WordScores(model.trained), float(model.trained.bias[1] - model.trained.bias[0])
    for doc_id in sorted(texts)[::3]:
        seen = []
        for w in subword.words(texts[doc_id]):
            if w not in seen:
                seen.append(w)
        shares = [float(s[1] - s[0]) for s in (scores.of([w])[0].astype(np.float64) for w in seen)]
        ends = range(max(1, len(shares) - model.span + 1))
        logit = max(sum(shares[i:i + model.span]) / model.span for i in ends) + bias
        want = 1 / (1 + np.exp(-(model.slope * logit + model.offset)))
        row = found[doc_id]
        assert row["score"] == pytest.approx(want, abs=1e-4) and row["predicted"] == int(row["score"] >= 0.3)
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)


def test_language_scores_word_by_word(spark, sf_dir, monkeypatch):
    models = []
    train = language.trained_model
    monkeypatch.setattr(language, "trained_model", lambda *a: models.append(train(*a)) or models[-1])
    found = {r["doc_id"]: r for r in language.op4_language(spark, sf_dir).collect()}
    model, texts = models[0], {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(found) == sorted(texts)
    scores = subword.WordScores(model.trained)
    for doc_id in sorted(texts)[::3]:
        text, row = texts[doc_id], found[doc_id]
        if not any(c.isalpha() for c in text or ""):
            assert row["lang_pred"] == "und"
            continue
        logits = np.mean([scores.of([w])[0].astype(np.float64) for w in subword.words(text)], axis=0) + model.trained.bias
        p = np.exp((logits - logits.max()) / model.temperature)
        p /= p.sum()
        assert row["lang_pred"] == model.names[int(p.argmax())] and row["score"] == pytest.approx(float(p.max()), abs=1e-4)
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_cut_training_texts_have_the_words_of_the_whole(spark):
    text = "Some, words - here: " * 3
    assert subword.words(subword.spread(subword.words(text), 16, 48)) == subword.words(text)
    long = [f"w{i}" for i in range(5000)]
    cut = subword.words(subword.spread(long, 16, 48))
    assert len(cut) <= 16 * 48 and cut[0] == "w0" and cut[-1] == "w4999"


def test_language_sample_takes_the_smallest_hashes(spark):
    rows = [(i, f"text {i}", "a" if i % 7 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {(r["text"].split()[1], r["lang"]) for r in language.training_rows(docs, F.lit(True), 20).collect()}
    hashed = docs.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).collect()
    want = {(str(r["doc_id"]), lang) for lang in "ab" for r in sorted((r for r in hashed if r["lang"] == lang), key=lambda r: r["h"])[:20]}
    assert got == want
