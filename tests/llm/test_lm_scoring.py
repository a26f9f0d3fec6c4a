"""Language-model scores against the formula on exact counts."""

import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from patronlens.llm import lm_scoring as lm


def expected(train, text):
    texts = [t.split() + [None] for t in train]
    n = Counter(w for t in texts for w in t)
    pairs = Counter(p for t in texts for p in zip(t, t[1:]))
    quantised = {p: float(lm.count_of(lm.level(np.array([k])))[0]) for p, k in pairs.items()}
    covered = Counter()
    for (h, _), q in quantised.items():
        covered[h] += q
    size = sum(n.values()) + 0.1 * (len(n) + 1)
    out, before = 0.0, None
    for i, w in enumerate(text.split() + [None]):
        p = (n[w] + 0.1) / size
        if i and n[before]:
            scale = max(covered[before], n[before])
            p = (lm.SHARE * quantised.get((before, w), 0.0) / scale
                 + (1 - lm.SHARE * covered[before] / scale) * p)
        out += math.log10(p)
        before = w
    return out


def test_pairs_seen_once_and_rare_words_count(spark):
    train = ["a b a b c", "a b d", "once only here", "c a b"]
    held = ["once only here", "a b c", "only once", "new a b", ""]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(held)],
                                 "doc_id long, text string, held_out boolean")
    model, stored = lm.train(spark.createDataFrame([(t,) for t in train], "text string"))
    found = {r.doc_id: r for r in lm.score(docs, model, stored).collect()}
    for i, text in enumerate(held):
        assert found[i].score == pytest.approx(expected(train, text), abs=1e-9), text
    assert found[0].score > found[0].base_score + 1  # each of its pairs is seen once


def test_filter_grows_with_its_pairs():
    keys = lm.words.mix(np.arange(300_000, dtype=np.uint64))
    bits = lm.filter_of(keys, np.ones(len(keys), np.int64))
    assert (lm.levels_of(keys, bits) >= 1).all() and len(bits) * 8 >= 10 * len(keys)
    others = lm.words.mix(np.arange(10**7, 10**7 + 100_000, dtype=np.uint64))
    assert (lm.levels_of(others, bits) > 0).mean() < 0.02


def test_no_training_text_and_missing_ids(spark):
    docs = spark.createDataFrame([(None, "a b", True), (1, None, True)],
                                 "doc_id long, text string, held_out boolean")
    model, stored = lm.train(spark.createDataFrame([], "text string"))
    assert {(r.doc_id, r.n_tokens, r.n_known, r.score) for r in lm.score(docs, model, stored).collect()} == {
        (None, 3, 0, 0.0), (1, 1, 0, 0.0)}


def test_chunks_and_long_texts_count_once(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK", 3)  # in this process; a task's parts come from it
    run = lm._counted(4)
    words, pairs = Counter(), Counter()
    text = "a b c a b c a b d a b"
    batch = lm.pa.RecordBatch.from_pydict({"text": [text, "", "a b"]})
    for part in run(iter([batch])):
        for kind, keys, n in zip(*(part.column(c).to_pylist() for c in ("kind", "keys", "n"))):
            of = np.uint64 if kind == lm.WORDS else np.uint32
            (words if kind == lm.WORDS else pairs).update(dict(zip(
                np.frombuffer(keys, of).tolist(), np.frombuffer(n, np.uint32).tolist())))
    assert sorted(words.values()) == sorted(Counter(text.split() + ["a", "b"] + [None] * 3).values())
    told = [t.split() + [None] for t in (text, "", "a b")]
    assert sorted(pairs.values()) == sorted(Counter(p for t in told for p in zip(t, t[1:])).values())


def test_workers_stay_small_beside_rich_text():
    """What a task holds follows the chunk and the batch, not the text: of 6 million tokens
    (nearly all pairs distinct) less than 24 bytes each while they are counted, and less than
    100 for each pair of a lane while it becomes a filter."""
    rng = np.random.default_rng(1)
    names = [f"w{i}" for i in range(60_000)]
    texts = [" ".join(names[i] for i in rng.integers(0, len(names), 50_000)) for _ in range(120)]
    batches = [lm.pa.RecordBatch.from_pydict({"text": texts[i:i + 2]}) for i in range(0, 120, 2)]
    tracemalloc.start()
    try:
        pairs = sum(sum(len(n) // 4 for n in part.column("n").to_pylist())
                    for part in lm._counted(64)(iter(batches))
                    if part.column("kind")[0].as_py() == lm.PAIRS)
        counting = tracemalloc.get_traced_memory()[1]
        keys = lm.words.mix(np.arange(1_000_000, dtype=np.uint64)).astype(np.uint32)
        tracemalloc.reset_peak()
        bits = lm.filter_of(keys, np.ones(len(keys), np.int64))
        found = lm.levels_of(keys.astype(np.uint64), bits)
        filtering = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert pairs > 5_900_000 and (found >= 1).all()
    assert counting < 24 * 6_000_000
    assert filtering < 100 * 1_000_000


def test_long_rows_meet_python_a_few_at_a_time(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sizes = lm.common.staged(spark.range(0, 1000, 1, 1).mapInArrow(lambda batches: (
        lm.pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long"), "t", lm.ROWS)
    assert max(r.n for r in sizes.collect()) <= 128
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
