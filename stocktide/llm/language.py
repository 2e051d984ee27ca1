"""Language of whole texts: averaged hashed subword embeddings, linear softmax, calibrated rejection.

Training texts are cut into short spans, so the model also serves short texts. A part of the training texts is kept
back: on it a temperature turns the mean logit of a whole text into a probability, and the rejection limit is set
so that at most ``reject`` of the rightly named texts fall below it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.subword import Spans, SubwordSoftmax, Trained, WordScores, softmax, spread, words
from stocktide.llm.toxicity import fold
from stocktide.llm.worker import map_rows, on_one_worker, renamed

#: Words in a training span, and spans taken of one text (evenly spread; scoring always uses the whole text).
SPAN, SPANS = 16, 12
#: Bound of the training sample: at most so many texts of each language, chosen by a hash of their id.
PER_LANGUAGE = 800
#: Spans of one text that are learned or calibrated from at most, and ids ranked per id wanted.
KEPT, MARGIN = 48, 4.0
#: More languages than this are not trained for; it bounds the sample.
LANGUAGES = 400
#: Texts of all languages together at most.
SAMPLE = 64_000
UNKNOWN = "und"


def training_rows(docs: DataFrame, use, per_language: int) -> DataFrame:
    """(doc_id, lang, text) of at most ``per_language`` rows of each language among those for which ``use`` holds; texts as their words.

    With many languages a language gets fewer, ``SAMPLE`` rows in all. Ids are taken by the smallest hashes: a limit from the language's count leaves
    few more than are wanted, and only these are ranked. Of a text with more than ``KEPT`` spans, so many are kept. Rows that
    repeat an id and language count once, with the smallest of their texts' hashes.
    """
    known = docs.filter(use).filter("lang IS NOT NULL AND doc_id IS NOT NULL")
    ids = known.select("doc_id", "lang").distinct()
    names = ids.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).toArrow()
    per_language = min(per_language, SAMPLE // max(1, names.num_rows))
    names = docs.sparkSession.createDataFrame(names, "lang string, n long")
    share = F.xxhash64("doc_id") / 2.0**64 + 0.5
    few = ids.join(F.broadcast(names), "lang").filter(share < MARGIN * per_language / F.col("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = few.withColumn("at", first).filter(F.col("at") <= per_language).select("doc_id", "lang")
    # At most LANGUAGES * per_language ids, so they are broadcast and the texts are not shuffled.
    found = known.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = lambda ids, names, texts: (ids, names, [spread(words(t), SPAN, KEPT) for t in texts])
    short = map_rows(found, ["doc_id", "lang", "text"], f"doc_id {kind}, lang string, text string", lambda: cut, by="text")
    once = short.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("row"))
    return once.select("doc_id", "lang", "row.text")


def trained_model(docs: DataFrame, use, per_language: int) -> LanguageModel:
    """Trained on one executor over the bounded sample; only the model reaches the driver."""
    def make(rows):
        return fit_language([(text, lang) for _, lang, text in sorted(rows, key=lambda r: (str(r[0]), r[1]))]).plain()

    return LanguageModel.read(on_one_worker(training_rows(docs, use, per_language), make))


@dataclass
class LanguageModel:
    names: list[str]
    trained: Trained | None
    temperature: float
    limit: float

    def plain(self) -> tuple:
        trained = self.trained
        return self.names, trained and (trained.by_row, trained.bias, trained.sizes), self.temperature, self.limit

    @staticmethod
    def read(values: tuple) -> "LanguageModel":
        return LanguageModel(values[0], values[1] and Trained(*values[1]), *values[2:])

    def namer(self):
        scores = WordScores(self.trained) if self.trained else None

        def name(text: str | None) -> tuple[str, float, bool]:
            if not scores or text is None or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, True
            logit = scores.of(words(text)).mean(axis=0, dtype=np.float64) + self.trained.bias
            p = softmax(logit[None] / self.temperature)[0]
            best = int(p.argmax())
            return self.names[best], float(p[best]), bool(p[best] < self.limit)

        return name


def fit_language(rows: list[tuple[str, str]], reject: float = 0.002, epochs: int = 4, seed: int = 11) -> LanguageModel:
    """Train on (text, language). Without rows with words, every text is unknown."""
    rows = [(found, lang) for found, lang in ((words(text), lang) for text, lang in rows) if found]
    names = sorted({lang for _, lang in rows})
    if not names:
        return LanguageModel([], None, 1.0, 0.0)
    random, model = np.random.default_rng(seed), SubwordSoftmax(len(names), seed=seed)
    back = random.permutation(len(rows))[: len(rows) // 5] if len(rows) >= 50 else np.arange(len(rows))
    fit_on = np.setdiff1d(np.arange(len(rows)), back) if len(rows) >= 50 else back
    spans, labels = [], []
    for i in fit_on.tolist():
        found, lang = rows[i]
        starts = range(0, len(found), SPAN)
        for j in np.unique(np.linspace(0, len(starts) - 1, SPANS).astype(int)).tolist():
            spans.append(found[starts[j]:starts[j] + SPAN])
            labels.append(names.index(lang))
    data, labels = Spans.of(spans, model.rows, model.sizes), np.array(labels, np.int64)
    for _ in range(epochs):
        order = random.permutation(len(spans))
        for at in range(0, len(order), 64):
            model.step(data, order[at:at + 64], labels[order[at:at + 64]], 0.15)
    trained = Trained.of(model)
    scores = WordScores(trained)
    logits = np.stack([scores.of(rows[i][0]).mean(axis=0, dtype=np.float64) for i in back.tolist()]) + trained.bias
    truth = np.array([names.index(rows[i][1]) for i in back.tolist()])
    each = np.arange(len(truth))
    loss = {t: -np.log(softmax(logits / t)[each, truth] + 1e-12).mean() + 1e-4 * abs(np.log(t)) for t in np.geomspace(0.05, 50, 61).tolist()}
    temperature = min(loss, key=loss.get)
    p = softmax(logits / temperature)
    right = p.max(1)[p.argmax(1) == truth]
    return LanguageModel(names, trained, temperature, float(np.quantile(right, reject)) if len(right) else 0.0)


def language(
    docs: DataFrame, folds: int = 3, held_out: int = 1, per_language: int = PER_LANGUAGE, rejecting: bool = True,
    id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected.

    Learns only from rows whose crc32(id as text) modulo ``folds`` is not ``held_out``. ``lang_pred`` is ``und`` for
    texts that are NULL or have no letter (score 0) and, with ``rejecting``, for those below the calibrated limit.
    Rows with a NULL id are never learned from and not held out; repeated rows give their own rows and
    count once in training. Without any language to learn every text is ``und``; an empty table gives an empty result;
    other columns are ignored.
    """
    table = renamed(docs, doc_id=id_column, text=text_column, lang=lang_column)
    out = F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    shared = docs.sparkSession.sparkContext.broadcast(trained_model(table, ~out, per_language).plain())

    def start():
        namer = LanguageModel.read(shared.value).namer()

        def name(ids, held, texts):
            found = [namer(t) for t in texts]
            return ids, held, [UNKNOWN if rejecting and r else n for n, _, r in found], [s for _, s, _ in found], [r for _, _, r in found]

        return name

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    return map_rows(table, ["doc_id", out.alias("held_out"), "text"], schema, start)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with a letter gets a learned language here; ``rejected`` marks those below the limit."""
    return language(spark.read.parquet(f"{sf_dir}/documents.parquet"), rejecting=False)
