"""Substring dedup and near-dedup against plain Python."""

import hashlib

import pytest

from llm import corpus
from patronlens.llm import minhash_dedup, substring_dedup


def split(text):
    return (text or "").encode().split()


def brute_repeats(rows, window):
    by_id = {}
    for row in rows:
        if row[0] is not None:
            by_id[row[0]] = split(row[1])
    seen, gone = set(), {}
    for doc_id in sorted(by_id):
        words = by_id[doc_id]
        mask = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                mask[i:i + window] = [True] * window
            seen.add(key)
        gone[doc_id] = mask
    return by_id, gone


@pytest.mark.parametrize("window, seed", [(20, 5), (7, 3), (1, 1)])
def test_repeats_match_brute_force(spark, window, seed):
    rows = corpus.rows()
    words, gone = brute_repeats(rows, window)
    found = substring_dedup.remove_repeats(corpus.documents(spark), window, seed).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is None:
            assert row.n_removed == 0
            continue
        kept = [w for w, g in zip(words[row.doc_id], gone[row.doc_id]) if not g]
        assert (row.n_words, row.n_removed) == (len(words[row.doc_id]), sum(gone[row.doc_id]))
        assert row.kept_text.encode() == b" ".join(kept)
        assert row.row == "clash" and row.start == 2


def test_pipeline_form_keeps_columns_and_untouched_texts(spark):
    docs = corpus.documents(spark)
    found = substring_dedup.without_repeats(docs)
    assert found.columns == docs.columns
    texts = {r[0]: r[1] for r in corpus.rows()}
    rows = {r.doc_id: r for r in found.collect()}
    assert rows[1].text == texts[1] and rows[402].text == texts[402]
    assert rows[200].text == "" and rows[400].text is None


def test_levels_double():
    assert substring_dedup.levels(20, 5) == [5, 10, 20]
    assert substring_dedup.levels(50, 8) == [8, 16, 32, 50]
    assert substring_dedup.levels(3, 5) == [3]


def shingles(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                 "abcdefghijklmnopqrstuvwxyz")).encode().split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed = changed or label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sets, label


def chain(n):
    """Documents that are near their neighbours only, in an order that hides it."""
    base = ["w%d" % i for i in range(200 + 12 * n)]
    return [((i * 7) % n, " ".join(base[12 * i:12 * i + 200]), "en", "x", 1) for i in range(n)]


@pytest.mark.parametrize("rows", [corpus.rows(), chain(11)], ids=["corpus", "chain"])
def test_components_match_brute_force(spark, rows):
    sets, label = brute_components(rows)
    found = minhash_dedup.near_duplicates(corpus.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
            continue
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == label[row.doc_id]
        assert row.kept == (row.doc_id == row.component_id)


def test_one_of_each_keeps_columns(spark):
    docs = corpus.documents(spark)
    kept = minhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert 2 in ids and 4 in ids and None in ids and not ids & {200, 201, 300, 301}


def test_empty_tables(spark):
    docs = corpus.documents(spark).where("false")
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert minhash_dedup.near_duplicates(docs).count() == 0


def test_sha_of_kept_words(spark):
    kept = substring_dedup.remove_repeats(corpus.documents(spark)).where("doc_id = 401").first()
    assert hashlib.sha256(kept.kept_text.encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
