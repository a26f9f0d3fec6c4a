"""The language model keeps all words of its rows, and small languages whole."""

import pytest
from pyspark.sql import functions as F

from patronlens.llm import language_id


def test_small_languages_are_taken_whole():
    assert language_id.shares({"a": 10, "b": 1000, "c": 3000}, 210) == {
        "a": 1.0, "b": pytest.approx(0.1), "c": pytest.approx(100 / 3000)}


def letters(i):
    out = ""
    for _ in range(5):
        out, i = out + chr(97 + i % 26), i // 26
    return out


def test_every_word_is_kept(spark):
    texts = [" ".join(map(letters, range(k * 21_000, (k + 1) * 21_000))) for k in range(10)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)],
                                 "doc_id long, text string, lang string")
    assert len(language_id.fit(docs)["index"][0]) == 210_000


def test_small_language_beside_a_large_one(spark):
    large = spark.range(2000).select("id", F.lit("the cat sat"), F.lit("en"))
    small = spark.range(10).select(F.col("id") + 5000, F.concat(
        F.lit("chat"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")), F.lit("fr"))
    model = language_id.fit(large.union(small).toDF("doc_id", "text", "lang"), 100)
    assert {f"chat{c}" for c in "abcdefghij"} <= set(model["index"][0])
