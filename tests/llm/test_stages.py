"""Pipeline stages keep all columns, whatever their names, and every result is whole."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from patronlens.llm import language_id, minhash_dedup, quality, substring_dedup

from .corpus import documents

CLASHES = ("__n", "__mean", "__lang", "__score", "__gone", "__kept", "__trusted", "row", "kept_text",
           "n_removed", "doc_id_", "hash")


@pytest.fixture(scope="module")
def docs(spark):
    base = documents(spark).drop("row", "hash")
    return base.withColumns({c: F.lit("mine") for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("stage", [
    lambda d, _: language_id.in_known_language(d), quality.good_documents,
    lambda d, _: minhash_dedup.one_of_each(d), lambda d, _: substring_dedup.without_repeats(d)])
def test_clashing_names_are_carried(docs, labels, stage):
    kept = stage(docs, labels)
    assert kept.columns == docs.columns and kept.count() > 0
    assert kept.where(" AND ".join(f"`{c}` = 'mine'" for c in CLASHES)).count() == kept.count()
    assert stage(docs.limit(0), labels).count() == 0


def test_signs_for_numbers_are_no_letters(spark):
    rows = [(i, "the house and the river", "en") for i in range(20)] + [
        (50 + i, "la maison et le fleuve", "fr") for i in range(20)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    given = {1: "½ ² ①", 2: "½ house", 3: "12 ... ³", 4: "x²"}
    got = {r.doc_id: r.lang_pred for r in language_id.predict(
        spark.createDataFrame(list(given.items()), "doc_id long, text string"), model).collect()}
    assert (got[1], got[3], got[2]) == ("und", "und", "en") and got[4] != "und"


def test_pipeline_stage_by_stage(spark, tmp_path):
    """What each stage says of its own input is what the next one gets, and all that is left is
    packed without gaps."""
    folder = str(tmp_path)
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, held, source)
        assert kept.columns == docs.columns
        kept.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
        before = {r.doc_id: r.text for r in held.select("doc_id", "text").collect()}
        after = {r.doc_id: r.text for r in kept.select("doc_id", "text").collect()}
        assert set(after) <= set(before)
        if name == "minhash_dedup":
            groups = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(
                held.select("doc_id", "text")).collect()}
            assert set(after) == {d for d in before if groups[d] == d}
        if name == "substring_dedup":
            assert set(after) == set(before) and all(
                len(after[d].split()) <= len(before[d].split()) for d in after if after[d])
        else:
            assert all(after[d] == before[d] for d in after)
        held = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, held, source).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in held.select("doc_id").collect()}
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    whole = corpus_pipeline.run(spark, source)
    assert sorted((r.doc_id, r.piece, r.length) for r in whole.collect()) == sorted(
        (r.doc_id, r.piece, r.length) for r in packed)
