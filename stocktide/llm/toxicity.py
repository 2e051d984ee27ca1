"""Toxicity by averaged subword embeddings and a linear softmax, so unseen misspellings share n-gram vectors.

A text is scored over all spans of ``SPAN`` of its different words, wherever they start, and its score is that of its worst
span, as a few words make a text toxic however long it is; repeats of a word say nothing new. Only texts are labelled, not spans: training starts with all spans
of toxic texts as toxic and then follows the worst spans. The logit of the worst span is calibrated to a
probability by logistic regression on the training texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.subword import Spans, SubwordSoftmax, Trained, WordScores, spread, words
from stocktide.llm.worker import map_rows, on_one_worker, release, renamed, slices_by_bytes

#: Words in a span.
SPAN = 24
#: Bound of the training sample: at most so many texts of each label, chosen by a hash of their id.
PER_LABEL = 2000
#: Spans of one text that are learned from at most.
KEPT = 64
CUT = 0.3


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def training_rows(docs: DataFrame, labels: DataFrame, use: Column, per_label: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_label`` rows of each label among those for which ``use`` holds; texts as their different words.

    Of a text with more than ``KEPT`` spans of different words, so many are kept. Rows that repeat an id
    count once, with the smallest of their texts' hashes.
    """
    marked = labels.filter("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = docs.select("doc_id").filter(use).join(marked, "doc_id").distinct()
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.filter("label = 0").orderBy(*order).limit(per_label).unionAll(
        known.filter("label = 1").orderBy(*order).limit(per_label)
    )
    # At most 2 * per_label ids, so they are broadcast and the texts are not shuffled.
    found = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("label").cast("int").alias("label"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = lambda ids, given, texts: (ids, given, [spread(distinct(t), SPAN, KEPT) for t in texts])
    short = map_rows(found, ["doc_id", "label", "text"], f"doc_id {kind}, label int, text string", lambda: cut, by="text")
    once = short.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("row"))
    return once.select("doc_id", "row.text", "row.label")


def trained_model(docs: DataFrame, labels: DataFrame, use: Column, per_label: int) -> ToxicityModel:
    """Trained on one executor over the bounded sample; only the model, of fixed size, reaches the driver."""
    def make(rows):
        return fit_toxicity([(text, label) for _, text, label in sorted(rows, key=lambda r: str(r[0]))]).plain()

    return ToxicityModel.read(on_one_worker(training_rows(docs, labels, use, per_label), make))


@dataclass
class ToxicityModel:
    trained: Trained | None
    slope: float
    offset: float
    span: int = SPAN

    def plain(self) -> tuple:
        trained = self.trained
        return trained and (trained.by_row, trained.bias, trained.sizes), self.slope, self.offset, self.span

    @staticmethod
    def read(values: tuple) -> "ToxicityModel":
        return ToxicityModel(values[0] and Trained(*values[0]), *values[1:])

    def scorer(self):
        scores = WordScores(self.trained) if self.trained else None

        def score(text: str | None) -> float:
            logit = 0.0
            if scores:
                share = scores.of(distinct(text))
                logit = worst(share[:, 1] - share[:, 0], self.span) + float(self.trained.bias[1] - self.trained.bias[0])
            return float(1 / (1 + np.exp(-np.clip(self.slope * logit + self.offset, -35, 35))))

        return score


def distinct(text: str | None) -> list[str]:
    """All different words of the whole text, in their first order."""
    return list(dict.fromkeys(words(text)))


def worst_at(shares: np.ndarray, span: int) -> tuple[int, float]:
    """Start and mean of the span of so many words with the highest mean, over all starts; the first of equal ones."""
    if len(shares) <= span:
        return 0, float(shares.sum()) / span
    total = np.concatenate([[0.0], np.cumsum(shares, dtype=np.float64)])
    sums = total[span:] - total[:-span]
    at = int(sums.argmax())
    return at, float(sums[at]) / span


def worst(shares: np.ndarray, span: int) -> float:
    return worst_at(shares, span)[1]


def fit_toxicity(rows: list[tuple[str, int]], span: int = SPAN, epochs: int = 8, seed: int = 7) -> ToxicityModel:
    """Train on (text, 0 or 1). Without rows of both labels every text scores that label's share (0 without rows)."""
    labels = np.array([y for _, y in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return ToxicityModel(None, 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))), span)
    random, model = np.random.default_rng(seed), SubwordSoftmax(2, floor=span, seed=seed)
    of, cuts = [], [0]

    def spans():  # one after the other: only the different words of all texts are held
        for i, (text, _) in enumerate(rows):
            found = distinct(text)
            cuts.append(cuts[-1] + len(found))
            for at in range(0, len(found), span):
                of.append(i)
                yield found[at:at + span]

    data = Spans.of(spans(), model.rows, model.sizes)
    of = np.array(of, np.int64)
    if not data.spans:
        return ToxicityModel(None, 0.0, float(np.log(labels.mean() / (1 - labels.mean()))), span)
    whole = np.concatenate(data.spans)
    filled = np.flatnonzero(np.diff(cuts))
    batches, target, order = data, labels[of], np.arange(len(of))
    for epoch in range(epochs):
        if epoch >= 2:  # of toxic texts the worst spans only, of others as many, the worst and any
            margin = (model.word_logits(data.rows, data.starts) @ np.array([-1.0, 1.0]))[whole]
            firsts = [cuts[i] + worst_at(margin[cuts[i]:cuts[i + 1]], span)[0] for i in filled]
            batches = Spans(data.rows, data.starts, [*data.spans, *(whole[a:min(a + span, cuts[i + 1])] for i, a in zip(filled, firsts))])
            target = np.concatenate([labels[of], labels[filled]])
            positive = len(of) + np.flatnonzero(labels[filled] == 1)
            hard = len(of) + np.flatnonzero(labels[filled] == 0)
            negative = np.flatnonzero(labels[of] == 0)
            order = np.concatenate([positive, positive, hard, random.choice(negative, min(len(negative), 2 * len(positive)), False)])
        else:
            many = 40 * len(rows) // 2
            order = random.permutation(len(of))[:many]
        random.shuffle(order)
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            model.step(batches, batch, target[batch], 0.15)
    trained = Trained.of(model)
    del data, batches, whole, model
    plainly = ToxicityModel(trained, 1.0, 0.0, span).scorer()
    p = np.array([plainly(t) for t, _ in rows])
    slope, offset = calibrated(np.log(p / (1 - p)), labels)
    return ToxicityModel(trained, slope, offset, span)


def calibrated(logit: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the logit, with smoothed targets, both labels weighing the same."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    x = np.stack([logit, np.ones_like(logit)], 1)
    scale = max(1e-6, float(np.abs(logit).max()))
    x[:, 0] /= scale
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (weight * (p - target)) + 1e-6 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        change = np.linalg.solve(curve, gradient)
        beta -= np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-8:
            break
    return float(max(beta[0], 0.0) / scale), float(beta[1])


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, per_label: int = PER_LABEL, cut: float = CUT,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Learns only from rows whose crc32(id as text) modulo ``folds`` is not ``held_out``. NULL and empty texts
    get the score of no evidence. Rows with a NULL id are never learned from and not held out; repeated rows give
    their own rows and count once in training (their label is 1 if any says so). Empty tables give an empty
    result, without labels every score is 0; other columns are ignored.
    """
    table = renamed(docs, doc_id=id_column, text=text_column)
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    model = trained_model(table, renamed(labels, doc_id=id_column, label=label_column), ~out, per_label)
    # Plain values, a table of fixed size: workers need not know the classes to read them.
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def start():
        scorer = ToxicityModel.read(shared.value).scorer()
        return lambda ids, held, texts: (ids, held, *zip(*[(s, int(s >= cut)) for s in map(scorer, texts)]))

    kind = docs.schema[id_column].dataType.simpleString()
    return map_rows(
        table, ["doc_id", out.alias("held_out"), "text"], f"doc_id {kind}, held_out boolean, score double, predicted int", start
    )


def without_toxic(
    docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, per_label: int = PER_LABEL, cut: float = CUT,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """The rows whose text scores below ``cut``, all columns; learning and definitions as in ``toxicity``."""
    table = renamed(docs, doc_id=id_column, text=text_column)
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    model = trained_model(table, renamed(labels, doc_id=id_column, label=label_column), ~out, per_label)
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    names, at = docs.columns, docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        scorer = ToxicityModel.read(shared.value).scorer()
        for part in slices_by_bytes(batches, f"c{at}"):
            yield part.filter(pa.array([scorer(t) < cut for t in part.column(at).to_pylist()], pa.bool_()))
        release()

    by_place = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    return by_place.mapInArrow(keep, by_place.schema).toDF(*names)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return toxicity(read("documents"), read("labels"))
