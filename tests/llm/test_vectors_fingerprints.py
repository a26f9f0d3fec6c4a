"""Nearest neighbours and fingerprints against brute force."""

import hashlib

import numpy as np

from llm import corpus
from pyspark.sql import functions as F
from patronlens.llm import fingerprints, nearest

NAN = float("nan")


def vectors(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(8, 24)) * 2
    found = middle[rng.integers(0, 8, n)] + rng.normal(size=(n, 24))
    found[50:90] = found[50]  # ties
    rows = [(i, v.tolist(), 7) for i, v in enumerate(found)]
    rows += [(700, None, 1), (800, [], 1), (900, [0.0] * 24, 1), (1000, [NAN] + [1.0] * 23, 1),
             (1100, [1.0, None] + [1.0] * 22, 1), (1200, [1.0] * 5, 1), (None, [1.0] * 24, 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def test_neighbours(spark):
    rows, frame = vectors(spark)
    found = nearest.search(frame, F.col("vec_id") % 20 == 0).collect()
    good = np.array([v for i, v, _ in rows[:600]])
    assert {r.query_id for r in found} == set(range(0, 600, 20))
    hits = 0
    for q in range(0, 600, 20):
        far = np.sqrt(((good - good[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        true = np.lexsort((np.arange(600), far))[:10]
        ours = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r[0] for r in ours] == list(range(1, 11))
        assert all(abs(far[v] - s) < 1e-12 for _, v, s in ours)
        hits += len({v for _, v, _ in ours} & set(true.tolist()))
    assert hits >= 0.9 * 300


def test_scan_keeps_all_near_rows():
    rng = np.random.default_rng(4)
    rows, queries = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    found = nearest.scan(queries, rows, np.zeros((20, 500), bool), 10)
    far = ((queries[:, None] - rows[None]) ** 2).sum(axis=2)
    kept = [len(set(np.argsort(f)[:10]) & set(c.tolist())) for f, c in zip(far, found)]
    assert np.mean(kept) > 9.5 and np.mean([len(c) for c in found]) < 250


def test_few_and_no_vectors(spark):
    rows, frame = vectors(spark)
    few = nearest.search(frame.where("vec_id < 4"), F.col("vec_id") == 0).collect()
    assert sorted((r.rank, r.query_id) for r in few) == [(1, 0), (2, 0), (3, 0)]
    assert nearest.search(frame.where("vec_id >= 700"), F.col("vec_id") % 100 == 0).count() == 0
    assert nearest.search(frame.where("false"), F.col("vec_id") % 100 == 0).count() == 0


def test_fingerprints_of_edited_texts(spark, tmp_path):
    rows = [r for r in corpus.rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    path = str(tmp_path)
    corpus.documents(spark, rows).write.parquet(path + "/documents.parquet")
    found = {r.doc_id: r for r in fingerprints.op6_document_fingerprints(spark, path).collect()}
    ids = sorted((r[0] for r in rows), reverse=True)
    texts = {r[0]: r[1] or "" for r in rows}
    by_text = {}
    for i, doc_id in enumerate(ids):
        own, other = texts[doc_id], texts[ids[(i + 1) % len(ids)]]
        cut = len(own) // 3
        row = found[doc_id]
        assert row.n_chars == len(own)
        edited = own[:len(own) - cut] + other[:cut]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert by_text.setdefault(own, row.fingerprint) == row.fingerprint
        same = sum(row.fingerprint[8 * k:8 * k + 8] == row.edited_fingerprint[8 * k:8 * k + 8]
                   for k in range(64)) / 64
        assert row.near_edited == same
    plain = [found[i] for i in range(10, 60)]
    assert np.mean([r.near_edited for r in plain]) > np.mean([r.near_next for r in plain]) + 0.1


def test_order_matters(spark):
    words = ["w%d" % i for i in range(40)]
    blocks = " ".join(words[20:] + words[:20])
    swapped = list(words)
    swapped[5], swapped[6] = swapped[6], swapped[5]
    docs = spark.createDataFrame([(1, " ".join(words), blocks, " ".join(swapped))],
                                 "doc_id long, a string, b string, c string")
    for name in ("a", "b", "c"):
        docs = fingerprints.fingerprint(docs, name, "f" + name)
    row = docs.select(fingerprints.likeness("fa", "fb").alias("moved"),
                      fingerprints.likeness("fa", "fc").alias("typo"),
                      fingerprints.likeness("fa", "fa").alias("self")).first()
    assert row.self == 1.0 and row.moved < 0.75 and row.typo > row.moved


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    docs = spark.createDataFrame([(i * i, "t%d" % i) for i in range(40)] + [(None, "none")],
                                 "doc_id long, text string").repartition(5)
    found = fingerprints.with_neighbour(docs, ["text"], lambda rows: rows).collect()
    after = {r.text: r.next_text for r in found}
    assert len(found) == 41
    assert all(after["t%d" % i] == "t%d" % (i - 1) for i in range(1, 40))
    assert after["t0"] == "none" and after["none"] == "t39"


def test_empty_table(spark, tmp_path):
    corpus.documents(spark).where("false").write.parquet(str(tmp_path) + "/documents.parquet")
    assert fingerprints.op6_document_fingerprints(spark, str(tmp_path)).count() == 0
