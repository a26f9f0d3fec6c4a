"""Toxicity by cumulative-link ordinal regression on the words of a text.

Grades are whole numbers from 0 (none) up. One weight per word is shared by all grades; the
ordered thresholds t_1 <= t_2 <= ... between them are the only parameters of a grade:
P(grade >= k) = sigmoid(weights of the text's distinct words - t_k). The expected severity is the
sum of these probabilities. Weights are fitted with an L1 penalty, which leaves the words that
say nothing at zero.

The regression is fitted on at most about `SAMPLE_ROWS` labelled documents (a share of them by
a hash of doc_id) and the `FEATURES` words in most of their texts, of those in `LEAST_TEXTS` at
least; that bounds the rows the driver fits on and the broadcast. Every text is scored whole.

Defined cases: null, empty and wordless texts have the severity of a text without known words
(the prior); a document labelled several times has its largest grade; null grades and rows
without doc_id do not teach; no labels, or one grade only: severity is that grade (0 without
any); repeated rows get equal results."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from patronlens.llm import common

SAMPLE_ROWS = 20_000
FEATURES = 100_000
LEAST_TEXTS = 5
PENALTY = 1e-4
ROUNDS = 600
SLICE = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def distinct_words(text: str | None) -> set[str]:
    text = text or ""
    found: set[str] = set()
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        found.update(_WORD.findall(text[at:end].lower()))
        at = end
    return found


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(distinct_words(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                          "grade": batch.column("grade"),
                                          "words": pa.array(found, pa.list_(pa.string()))})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def regress(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, width: int,
            penalty: float = PENALTY, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the likelihood, less the L1 penalty. A
    feature `columns[i]` is present in the text `rows[i]`. Adam with a proximal step."""
    n, k = len(grades), int(grades.max())
    weights = np.zeros(width)
    # thresholds as a first one and positive gaps, so that they stay in order
    share = np.clip([(grades >= i).mean() for i in range(1, k + 1)], 1e-6, 1 - 1e-6)
    start = -np.log(share / (1 - share))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    moment, square = np.zeros(width + k), np.zeros(width + k)
    for t in range(1, rounds + 1):
        gaps = np.exp(np.clip(free[1:], -20, 20))
        limits = np.concatenate((free[:1], free[0] + np.cumsum(gaps)))
        eta = np.bincount(rows, weights[columns], n)
        edges = np.concatenate(([-np.inf], limits, [np.inf]))
        upper = _sigmoid(eta - edges[grades])  # P(grade >= own)
        lower = _sigmoid(eta - edges[grades + 1])  # P(grade >= own + 1)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        slope = -(du - dl) / p / n  # of the loss in eta
        dlimits = np.bincount(grades, du / p, k + 1)[1:] - np.bincount(grades, dl / p, k + 1)[:-1]
        dlimits = dlimits / n
        dfree = np.concatenate(([dlimits.sum()], gaps * np.cumsum(dlimits[::-1])[::-1][1:]))
        gradient = np.concatenate((np.bincount(columns, slope[rows], width), dfree))
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        rate = 0.1 * (1 - t / (rounds + 1)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-8)
        step = rate * moment / (1 - 0.9 ** t)
        free -= step[width:]
        weights -= step[:width]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate[:width] * penalty, 0)
    gaps = np.exp(np.clip(free[1:], -20, 20))
    return weights, np.concatenate((free[:1], free[0] + np.cumsum(gaps)))


def fit(docs: DataFrame, labels: DataFrame, grade: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> dict:
    """Weights by word and thresholds from `labels` (doc_id, grade) of `docs`."""
    known = (labels.where(F.col("doc_id").isNotNull() & (F.col(grade) >= 0))
             .groupBy("doc_id").agg(F.max(grade).cast("int").alias("grade")))
    known = common.staged(known, "grades")
    rows = known.count()
    if rows > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
                            < int((1 << 20) * sample_rows / rows))
    taught = common.staged(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(known, "doc_id").select("doc_id", "text", "grade")
        .mapInArrow(_sparse, "doc_id long, grade int, words array<string>"), "taught")
    grades = common.fetched(taught.select("doc_id", "grade").orderBy("doc_id"))
    if not len(grades) or grades["grade"].nunique() < 2:
        return {"weights": {}, "limits": [], "flag_at": 0.5,
                "base": int(grades["grade"].max()) if len(grades) else 0}
    words = common.fetched(
        taught.select(F.explode("words").alias("word")).groupBy("word")
        .agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= LEAST_TEXTS)
        .orderBy(F.desc("texts"), "word").limit(FEATURES).select("word"))["word"]
    index = {w: i for i, w in enumerate(words)}
    place = {d: i for i, d in enumerate(grades["doc_id"])}
    at, columns = array("q"), array("q")
    for row in taught.select("doc_id", "words").toLocalIterator():
        found = [index[w] for w in row.words if w in index]
        columns.extend(found)
        at.extend([place[row.doc_id]] * len(found))
    rows, columns = np.frombuffer(at, np.int64), np.frombuffer(columns, np.int64)
    known = grades["grade"].to_numpy(np.int64)
    weights, limits = regress(rows, columns, known, len(index))
    # what nearly all texts of grade 0 stay below, with room for new ones
    some = _sigmoid(np.bincount(rows, weights[columns], len(known)) - limits[0])
    usual = float(np.quantile(some[known == 0], 0.999)) if (known == 0).any() else 0.5
    return {"weights": {w: float(weights[i]) for w, i in index.items() if weights[i]},
            "limits": limits.tolist(), "base": 0, "flag_at": min(max(1.5 * usual, 0.15), 0.5)}


def severity(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, severity, grade, toxic) of every row: the expected and the likeliest grade, and
    whether a grade above 0 is likelier than for all but few texts of grade 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        weights, limits = model["weights"].get, np.array(model["limits"])
        for batch in batches:
            eta = np.array([sum(map(weights, distinct_words(t), repeat(0.0)))
                            for t in batch.column("text").to_pylist()])
            above = _sigmoid(eta[:, None] - limits[None, :])
            steps = np.concatenate((np.ones((len(eta), 1)), above, np.zeros((len(eta), 1))), axis=1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "severity": pa.array(above.sum(axis=1) + model["base"]),
                "grade": pa.array((np.argmax(-np.diff(steps, axis=1), axis=1)
                                   + model["base"]).astype(np.int32)),
                "toxic": pa.array((above[:, 0] >= model["flag_at"]) if len(limits)
                                  else np.full(len(eta), model["base"] > 0))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, severity double, grade int, toxic boolean")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return severity(docs, fit(docs, common.table(spark, sf_dir, "labels")))
