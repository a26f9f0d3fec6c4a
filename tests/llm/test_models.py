"""Trained models: exact counts, proper probabilities, held-out accuracy, defined cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from llm import corpus
from patronlens.llm import common, language_id, lm_scoring, quality, toxicity


def held_out(doc_id, folds):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % folds == 0


def test_language(spark):
    docs = corpus.documents(spark)
    model = language_id.fit(language_id.training_rows(docs))
    assert model["langs"] == ["en", "fr"]
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    right = [found[i].lang_pred == ("en", "fr")[i % 2] for i in range(60)]
    assert sum(right) == 60
    for i in (400, 401, 402, 404):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert found[409].lang_pred in ("en", "fr") and all(0 <= r.score <= 1 for r in found.values())
    kept = language_id.in_known_language(docs)
    assert kept.columns == docs.columns and not {400, 404} & {r.doc_id for r in kept.collect()}


def test_language_without_training(spark):
    docs = corpus.documents(spark)
    model = language_id.fit(docs.where("false"))
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} == {"und"}


def test_unseen_words_fall_back():
    index = {0: {}, 4: {" wal": 0}, 3: {"ing": 1}, 2: {}, 1: {"z": 2}}
    assert language_id._backoff("walks", index) == [0]
    assert language_id._backoff("sing", index) == [1]
    assert language_id._backoff("zz", index) == [2, 2]
    assert language_id._backoff("qq", index) == []


@pytest.mark.parametrize("lane_bytes", [8, 1 << 23])
def test_lm_counts_are_exact(spark, lane_bytes):
    rows = corpus.rows()
    docs = corpus.documents(spark).select(
        "doc_id", "text", common.in_fold("doc_id", 10).alias("held_out"))
    model, counts = lm_scoring.train(docs.where("NOT held_out").select("text"), lane_bytes)
    found = sorted(((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                    for r in lm_scoring.score(docs, model, counts).collect()))

    def tokens(text):
        return [*(text or "").translate(str.maketrans(
            "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split(), None]

    count = Counter()
    for row in rows:
        if not held_out(row[0], 10):
            count.update(tokens(row[1]))
    n, v = sum(count.values()), len(count)
    wanted = sorted((row[0] or -1, len(tokens(row[1])), sum(count[t] > 0 for t in tokens(row[1])), n,
                     sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(row[1])))
                    for row in rows)
    assert len(found) == len(wanted)
    for ours, theirs in zip(found, wanted):
        assert ours[:4] == theirs[:4] and ours[4] == pytest.approx(theirs[4])
        assert ours[5] <= 0


def test_filter_holds_levels():
    keys = np.arange(1, 500, dtype=np.uint64) * np.uint64(7919)
    n = np.arange(1, 500)
    bits = np.zeros(1 << 20, bool)
    levels = lm_scoring.level(n)
    for q in range(1, levels.max() + 1):
        segment, at = lm_scoring.probes(keys[levels >= q], q, len(bits))
        bits[(segment[:, None] * lm_scoring._SEGMENT_BITS + at).ravel()] = True
    found = lm_scoring.levels_of(keys, np.packbits(bits))
    assert (found >= levels).all() and (found == levels).mean() > 0.99
    assert not lm_scoring.levels_of(keys + np.uint64(1), np.packbits(bits)).any()


def test_lm_without_training(spark):
    docs = corpus.documents(spark).selectExpr("doc_id", "text", "true AS held_out")
    model, counts = lm_scoring.train(docs.where("false").select("text"))
    rows = lm_scoring.score(docs, model, counts).collect()
    assert len(rows) == docs.count() and {r.train_tokens for r in rows} == {0}


def labels(spark, some):
    return spark.createDataFrame(some, "doc_id long, quality int, toxic int")


def test_kneser_ney_sums_to_one(spark):
    docs = corpus.documents(spark).where("text IS NOT NULL AND doc_id < 60")
    model = quality.fit(docs)
    grams = model["orders"][4][0]
    symbols = np.arange(model["table"].max() + 1)
    for context in np.unique(grams >> quality.BITS)[:20].tolist():
        p = np.exp(quality.log_probabilities((context << quality.BITS) | symbols, model))
        assert p.sum() == pytest.approx(1, abs=0.02)


def kneser_ney(texts, order):
    """Probabilities of symbols after their contexts, from plain counts of tuples."""
    seen = [Counter() for _ in range(order + 1)]
    for symbols in texts:
        padded = [0] * (order - 1) + symbols
        seen[order].update(tuple(padded[i:i + order]) for i in range(len(symbols)))
    for k in range(order - 1, 0, -1):  # how many different symbols stand before
        seen[k] = Counter(g[1:] for g in seen[k + 1])
    size = len({s for t in texts for s in t} - {1, 3}) + 4

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / size
        of = Counter(seen[k].values())
        if of[1] and of[2]:
            y = of[1] / (of[1] + 2 * of[2])
            cuts = [1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2],
                    3 - 4 * y * of[4] / of[3] if of[3] else 1.5]
            cuts = [min(max(c, 0.05), i + 0.95) for i, c in enumerate(cuts)]
        else:
            cuts = [0.5, 0.75, 0.9]
        after = [n for g, n in seen[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        held = sum(cuts[min(n, 3) - 1] for n in after) / sum(after)
        n = seen[k][gram]
        own = max(n - cuts[min(n, 3) - 1], 0) / sum(after) if n else 0
        return own + held * p(gram[1:])

    return p


def test_kneser_ney_by_brute_force(spark):
    texts = ["abra cadabra abra", "cab  bad abracad", "dab a cab", "a", "bad dab abra \u4e2d\u6587 cad"]
    model = quality.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    told = [quality.symbols(t, model["table"]).tolist() for t in texts]
    assert len({s for t in told for s in t}) == 9  # no two characters are one symbol
    p = kneser_ney(told, quality.ORDER)
    for text in texts + ["dada cab zz", "\u6587\u4e2d a"]:
        symbols = quality.symbols(text, model["table"])
        padded = [0] * (quality.ORDER - 1) + symbols.tolist()
        wanted = [math.log(p(tuple(padded[i:i + quality.ORDER]))) for i in range(len(symbols))]
        found = quality.log_probabilities(quality.keys(symbols, quality.ORDER), model)
        assert found.tolist() == pytest.approx(wanted)


def letter_text(i):
    """Text number `i`, with an n-gram that no other one has."""
    return "abra cadabra " + "".join(chr(97 + i // 26 ** k % 26) for k in range(4))


def test_quality_learns_from_all_trusted_documents(spark):
    texts = [letter_text(i) for i in range(21_000)]
    model = quality.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    wanted = {g for t in texts for g in quality.keys(
        quality.symbols(t, model["table"]), quality.ORDER).tolist()}
    assert set(model["orders"][quality.ORDER][0].tolist()) == wanted


@pytest.mark.parametrize("held", [0, 40, 300])
def test_quality_beyond_memory_is_the_same(spark, held):
    docs = corpus.documents(spark)
    trusted = docs.where("text IS NOT NULL AND doc_id < 40")
    whole, cut = quality.fit(trusted), quality.fit(trusted, held=held)
    assert "rest" not in whole and len(cut["orders"][quality.ORDER][0]) <= held
    columns = ["doc_id", "text", "__n", "__mean", "__spread", "__fresh", "__fresh_spread"]

    def rows(model):
        return sorted((tuple(-1 if v is None else v for v in (r.doc_id, r.text or "", *r[2:]))
                       for r in quality.score(docs, model).select(columns).collect()))

    wanted, found = rows(whole), rows(cut)
    assert len(wanted) == docs.count() and [r[:3] for r in found] == [r[:3] for r in wanted]
    for ours, theirs in zip(found, wanted):
        assert ours[3:] == pytest.approx(theirs[3:], abs=1e-6)
    known = labels(spark, [(i, 1, 0) for i in range(40)])
    held_back = {(r.doc_id, r.text): r["__kept"] for r in quality.judge(docs, known, held=held).collect()}
    assert held_back == {(r.doc_id, r.text): r["__kept"] for r in quality.judge(docs, known).collect()}


def test_quartiles_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(lang, kind, float(x)) for lang, size in (("en", 20_000), ("fr", 7), (None, 1))
            for kind in ("above", "below") for x in rng.gamma(2, 0.2, size)]
    rows += [("de", "above", 1.5)] * 9 + [("de", "above", 1.50001)] * 3
    wanted = {}
    for lang, kind, x in rows:
        wanted.setdefault((lang, kind), []).append(x)
    frame = spark.createDataFrame(rows, "lang string, kind string, x double")
    found = {(r.lang, r.kind): (r.q1, r.q3) for r in quality.quartiles(frame).collect()}
    assert found == {g: tuple(sorted(x)[math.ceil(len(x) * q / 4) - 1] for q in (1, 3))
                     for g, x in wanted.items()}


def test_windows_forget():
    grams = np.array([7, 8, 7, 7] + [9] * quality.WINDOW + [7, 7, 8], np.int64)
    owner = np.array([0] * (len(grams) - 2) + [1, 1])
    place = np.append(np.arange(len(grams) - 2), [0, 1])
    found = np.flatnonzero(quality.first_in_window(grams, owner, place)).tolist()
    met, wanted = set(), []
    for i, key in enumerate(zip(grams.tolist(), owner.tolist(), (place // quality.WINDOW).tolist())):
        if key not in met:
            wanted.append(i)
        met.add(key)
    assert found == wanted


def test_quality(spark):
    docs = corpus.documents(spark)
    bad = [(500, "|#| @@ !! ~~ ^^ {} <> |#| @@ !! ~~ ^^ {} <> |#| @@ !! ~~", "en", "x", 1)]
    bad.append((501, "The " * 400, "en", "x", 1))
    docs = corpus.documents(spark, corpus.rows() + bad)
    known = labels(spark, [(i, 1, 0) for i in range(60)] + [(None, 1, 0), (3, 1, 1), (500, 0, 0)])
    found = {r.doc_id: r for r in quality.judge(docs, known).collect()}
    assert all(found[i]["__kept"] for i in range(60))
    assert not found[501]["__kept"]
    assert not found[500]["__kept"] and not found[400]["__kept"] and not found[402]["__kept"]
    kept = quality.good_documents(docs, known)
    assert kept.columns == docs.columns
    none = quality.judge(docs, known.where("false")).collect()
    assert all(r["__kept"] == bool((r.text or "").split()) for r in none)


def test_ordinal_regression_recovers_order():
    rng = np.random.default_rng(2)
    present = rng.random((3000, 6)) < 0.3
    eta = present @ np.array([3.0, 2.0, 1.0, 0, 0, 0])
    grades = (eta + rng.logistic(size=3000) > 2).astype(int) + (eta + rng.logistic(size=3000) > 4)
    rows, columns = np.nonzero(present)
    weights, limits = toxicity.regress(rows, columns, grades, 6, 1e-4)
    assert weights[0] > weights[1] > weights[2] > abs(weights[3:]).max() and limits[0] < limits[1]


def penalised(present, grades, weights, limits, penalty):
    """Mean of -log P(own grade) by the definition of the model, and the L1 penalty."""
    lost = 0.0
    for row, grade in zip(present.tolist(), grades.tolist()):
        eta = sum(w for w, there in zip(weights, row) if there)
        above = [1.0, *(1 / (1 + math.exp(limit - eta)) for limit in limits), 0.0]
        lost -= math.log(above[grade] - above[grade + 1])
    return lost / len(grades) + penalty * sum(map(abs, weights))


def test_ordinal_regression_by_brute_force():
    rng = np.random.default_rng(5)
    present = rng.random((300, 3)) < 0.4
    eta = present @ np.array([2.0, -1.0, 0.0])
    grades = (eta + rng.logistic(size=300) > 1).astype(int) + (eta + rng.logistic(size=300) > 3)
    rows, columns = np.nonzero(present)
    weights, limits = toxicity.regress(rows, columns, grades, 3, 0.01, 800)
    best = penalised(present, grades, weights.tolist(), limits.tolist(), 0.01)
    at = np.concatenate((weights, limits))
    for size in (0.5, 0.1, 0.02):  # the loss is convex: a minimum around is the minimum
        for step in np.vstack((np.eye(5), -np.eye(5), rng.normal(size=(10, 5)))) * size:
            w, cut = np.split(at + step, [3])
            if cut[0] < cut[1]:
                assert penalised(present, grades, w.tolist(), cut.tolist(), 0.01) > best - 2e-5


def test_toxicity(spark):
    rows = [(1000 + i, "plain words here %d kind house" % i + (" nasty awful" if i % 4 == 0 else ""),
             "en", "x", 1) for i in range(400)]
    rows += corpus.rows()
    docs = corpus.documents(spark, rows)
    known = labels(spark, [(1000 + i, 1, int(i % 4 == 0)) for i in range(300)]
                   + [(None, 1, 1), (1000, 1, None), (1001, 1, 0)])
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.severity(docs, model).collect()}
    for i in range(300, 400):
        assert found[1000 + i].toxic == (i % 4 == 0) == (found[1000 + i].grade > 0)
    assert found[400].grade == 0 and not found[400].toxic and found[401].severity == found[400].severity
    none = toxicity.severity(docs, toxicity.fit(docs, known.where("false"))).collect()
    assert {r.severity for r in none} == {0.0}
