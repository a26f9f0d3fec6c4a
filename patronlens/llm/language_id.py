"""Language identification: words first, then shorter and shorter pieces of them.

Training counts words and character n-grams per language on labelled documents. A known word
scores its smoothed log frequency in every language; a word that training has not seen scores
the mean log frequency of its 4-grams, or if none of them is known of its 3-grams, 2-grams or
letters. The sums over a text, as posterior probabilities under equal priors, give the
language and its score.

The model is fitted on at most about `SAMPLE_ROWS` labelled rows, taken by a hash of doc_id:
small languages whole, the others as many rows each. It holds every word and piece of these
rows, so the broadcast is bounded by their text.
Every text is read whole, long ones in slices cut between words.

Defined cases: text null or without a letter: `und` with score 0; letters but no known piece:
the first language in alphabetical order with an equal share; no labelled row at all: `und`;
rows without doc_id or lang are not learned from; repeated rows are predicted alike."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronlens.llm import common

SAMPLE_ROWS = 20_000
SIZES = (4, 3, 2, 1)
SMOOTHING = 0.5
SLICE = 1 << 20
FOLDS = 5

_WORD = re.compile(r"[^\W\d_]+")


def text_words(text: str) -> Iterator[list[str]]:
    """Lower-cased runs of letters, a slice of the text at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        # the pattern also takes signs for numbers, such as fractions, which are no letters
        yield [w for w in _WORD.findall(text[at:end].lower()) if w.isalpha() or any(map(str.isalpha, w))]
        at = end


def pieces(word: str, size: int) -> list[str]:
    marked = f" {word} " if size > 1 else word
    return [marked[i:i + size] for i in range(len(marked) - size + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, Counter] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            for found in text_words(text):
                counts.setdefault(lang, Counter()).update(found)
        for lang, found in counts.items():
            tables = {0: found} | {n: Counter() for n in SIZES}
            for word, count in found.items():
                for n in SIZES:
                    for piece in pieces(word, n):
                        tables[n][piece] += count
            for n, table in tables.items():
                if table:
                    yield pa.RecordBatch.from_pydict({
                        "size": pa.array([n] * len(table), pa.int32()),
                        "piece": pa.array(list(table)),
                        "lang": pa.array([lang] * len(table)),
                        "n": pa.array(list(table.values()), pa.int64())})


def shares(rows: dict[str, int], room: int) -> dict[str, float]:
    """The share of each language's rows to take: all of a small language, and as many rows of
    each larger one as then fit into `room`."""
    out = {}
    for i, (lang, n) in enumerate(sorted(rows.items(), key=lambda x: x[1])):
        out[lang] = min(1.0, room / (len(rows) - i) / n)
        room -= n * out[lang]
    return out


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Learn from text and lang of `docs`: languages, and for words (size 0) and pieces the
    row of a table of log frequencies."""
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    rows = {r.lang: r.n for r in known.groupBy(F.col("lang").cast("string").alias("lang"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each language
    if sum(rows.values()) > sample_rows:
        taken = F.lit(0)
        for lang, share in shares(rows, sample_rows).items():
            taken = F.when(F.col("lang").cast("string") == lang,
                           F.lit(round((1 << 20) * share))).otherwise(taken)
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < taken)
    counted = common.staged(
        known.select(F.col("text").cast("string").alias("text"),
                     F.col("lang").cast("string").alias("lang"))
        .mapInArrow(_count, "size int, piece string, lang string, n long")
        .groupBy("size", "piece", "lang").agg(F.sum("n").alias("n")), "languages")
    langs = [r.lang for r in counted.select("lang").distinct().orderBy("lang").collect()]
    entries = common.fetched(counted.groupBy("size", "piece").agg(
        F.sum("n").alias("total"), *(F.sum(F.when(F.col("lang") == lang, F.col("n"))).alias(f"n{i}")
                                     for i, lang in enumerate(langs))))
    common.unstage(counted)
    index: dict[int, dict[str, int]] = {n: {} for n in (0, *SIZES)}
    counts = entries[[f"n{i}" for i in range(len(langs))]].fillna(0).to_numpy(float)
    scores = np.zeros((len(entries), len(langs)), np.float32)
    for size, at in entries.groupby("size").indices.items():
        index[size] = dict(zip(entries["piece"].to_numpy()[at].tolist(), at.tolist()))
        part = counts[at] + SMOOTHING
        scores[at] = np.log(part / part.sum(axis=0))
    return {"langs": langs, "index": index, "scores": scores}


def _backoff(word: str, index: dict[int, dict[str, int]]) -> list[int]:
    for n in SIZES:
        table = index[n]
        found = [table[p] for p in pieces(word, n) if p in table]
        if found:
            return found
    return []


def classify(text: str | None, model: dict) -> tuple[str, float]:
    langs, index, scores = model["langs"], model["index"], model["scores"]
    total, seen = np.zeros(len(langs)), False
    for found in text_words(text or ""):
        seen = seen or bool(found)
        at = np.fromiter(map(index[0].get, found, repeat(-1)), np.int64, len(found))
        total += scores[at[at >= 0]].sum(axis=0, dtype=float)
        extra: list[int] = []
        weights: list[float] = []
        for i in np.flatnonzero(at < 0).tolist():
            known = _backoff(found[i], index)
            extra += known
            weights += [1 / len(known)] * len(known) if known else []
        if extra:
            total += np.array(weights) @ scores[extra]
    if not seen or not langs:
        return "und", 0.0
    odds = np.exp(total - total.max())
    best = int(np.argmax(odds))
    return langs[best], float(odds[best] / odds.sum())


def predict(docs: DataFrame, model: dict, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with the predicted language and its score as two more columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(text, shared.value) for text in batch.column("text").to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns))
            yield pa.RecordBatch.from_pydict(columns | {
                lang: pa.array([f[0] for f in found], pa.string()),
                score: pa.array([f[1] for f in found], pa.float64())})

    kept = docs.drop(lang, score)
    return kept.mapInArrow(run, common.extended(kept.schema, **{lang: "string", score: "double"}))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang").where(~common.in_fold("doc_id", FOLDS))


def in_known_language(docs: DataFrame) -> DataFrame:
    """Rows of `docs` in a language learned from them, with the columns as they are. Rejected:
    no letters, and letters that speak for no language more than for the others."""
    model = fit(training_rows(docs))
    even = 1.01 / len(model["langs"]) if len(model["langs"]) > 1 else 0.0
    found = predict(common.bundled(docs), model, "__lang", "__score")
    return common.unbundled(found.where((F.col("__lang") != "und") & (F.col("__score") >= even)), docs)


def op10_language_id(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), fit(training_rows(docs)))
    return found.select("doc_id", common.in_fold("doc_id", FOLDS).alias("held_out"),
                        "lang_pred", "score")
