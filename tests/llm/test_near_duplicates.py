"""Near-duplicates among short texts, whose estimates rest on few shingles."""

import numpy as np

from patronlens.llm import minhash_dedup, words


def test_short_copies_at_the_threshold_are_linked(spark):
    rows = []
    for i in range(600):  # 4 against 3 shingles: similarity 0.75
        text = [f"w{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:-1]))]
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {
        d: d - d % 2 for d, _ in rows}


def test_estimates_of_small_sets_centre_on_the_similarity():
    def planes(values):
        return minhash_dedup._packed(minhash_dedup.minima(values, 240)).view(np.uint8)

    found = []
    for i in range(400):
        x = words.mix(np.arange(4, dtype=np.uint64) + np.uint64(1000 * i))
        a, b = (np.unpackbits(planes(v)).reshape(2, 256)[:, :240] for v in (x, x[:3]))
        found.append(((a == b).all(axis=0).mean() - 0.25) / 0.75)
    assert min(found) > 0.75 - minhash_dedup.SLACK and abs(np.mean(found) - 0.75) < 0.01
