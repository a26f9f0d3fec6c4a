"""Packing and piece encoding: exact places, exact round trips, best segmentations."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np

from llm import corpus
from patronlens.llm import packing, pieces


def test_pack_places_every_piece(spark):
    rows = corpus.rows()
    found = packing.pack(corpus.documents(spark), capacity=256).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    wanted = Counter()
    for row in rows:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start:start + 256]
            wanted[row[0], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert wanted == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r.length for r in found)
    assert len(sequences) <= -(-total // 256) * 1.05 + 1


def test_plan_uses_up_any_histogram():
    rng = np.random.default_rng(1)
    for capacity, most in ((16, 5), (100, 40), (100, 0)):
        histogram = rng.integers(0, most + 1, capacity + 1)
        histogram[0] = 0
        used = Counter()
        for pattern, times in packing.plan(histogram, capacity):
            assert sum(pattern) <= capacity and times > 0
            for length in pattern:
                used[length] += times
        assert used == Counter({i: int(n) for i, n in enumerate(histogram) if n})


def test_least_squares_finds_an_exact_fit():
    patterns = np.array([[6, 4, 0], [5, 5, 0], [10, 0, 0]])
    histogram = np.zeros(11)
    histogram[[4, 5, 6, 10]] = 3, 8, 3, 2
    assert np.allclose(packing.fit_counts(patterns, histogram, 2000), [3, 4, 2], atol=1e-2)


def test_pack_empty_table(spark):
    assert packing.pack(corpus.documents(spark).where("false")).count() == 0


def test_round_trip_and_columns(spark):
    docs = corpus.documents(spark)
    found = pieces.decode(pieces.encode(docs))
    assert found.columns == [*docs.columns, "ids", "decoded"]
    rows = found.collect()
    assert len(rows) == len(corpus.rows())
    assert all(r.decoded == (r.text or "") for r in rows)
    assert pieces.encode(docs.where("false")).count() == 0


def test_best_segmentation_by_brute_force():
    vocabulary = pieces.Vocabulary(pieces.vocabulary_path())
    rng = random.Random(5)
    words = ["▁" + "".join(rng.choice("theransiou") for _ in range(rng.randint(0, 8)))
             for _ in range(80)] + ["▁▁▁x", "日", "▁é日"]

    def cost(word, cuts):
        edges = [0, *cuts, len(word)]
        total = 0.0
        for a, b in zip(edges, edges[1:]):
            piece = vocabulary.found.get(word[a:b])
            if piece is None and b - a > 1:
                return -np.inf
            total += vocabulary.unknown if piece is None else piece[0]
        return total

    scores = {i: s for piece in vocabulary.found.values() if piece for s, i in [piece]}
    found = dict(vocabulary.encode_words(list(set(words))))
    for word in words:
        inner = range(1, len(word))
        best = max(cost(word, cuts) for n in range(len(word))
                   for cuts in itertools.combinations(inner, n))
        ids = found[word]
        assert b"".join(vocabulary.bytes_of[i] for i in ids).decode() == word.replace("▁", " ")
        if all(i in scores for i in ids):
            assert sum(scores[i] for i in ids) == best


def test_decode_odd_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, [70_000, -1, None]), (3, [258])],
                                 "doc_id long, ids array<int>")
    assert [r.decoded for r in pieces.decode(rows).orderBy("doc_id").collect()] == ["", "", "�"]
