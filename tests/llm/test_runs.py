"""Periodic runs against a comparison of all words at all distances."""

import hashlib
import random
import zlib

import pytest

from patronlens.llm import runs as R

from .corpus import documents, rows


def brute(parts):
    out = []
    n = len(parts)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and parts[j] == parts[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(
                    q % r == 0 and a <= i and j + q <= a + l for a, l, r in out):
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def sample(rng):
    k = rng.choice([1, 2, 2, 3, 5, 30])
    out = []
    for _ in range(rng.randint(1, 5)):
        block = [b"%d" % rng.randrange(k) for _ in range(rng.randint(1, 9))]
        out += block * rng.choice([1, 1, 2, 4, 5, 9]) + block[:rng.randint(0, len(block))]
    return out * rng.choice([1, 1, 1, 2, 4])


def test_random_texts():
    rng = random.Random(2)
    for _ in range(3000):
        parts = sample(rng)
        assert R.runs_of(parts) == brute(parts), parts


@pytest.mark.parametrize("parts", [
    [], [b"a"] * 5, [b"a"] * 6, [b"a"] * 3000, [b"a", b"b"] * 4, [b"%d" % i for i in range(700)] * 4,
    [b"%d" % (bin(i).count("1") % 2) for i in range(1024)],  # no cube at all
    [b"a", b"b"] * 50 + [b"a"] * 50 + [b"b", b"a"] * 50,
    ([b"a"] * 7 + [b"b"]) * 6])
def test_awkward_texts(parts):
    assert R.runs_of(parts) == brute(parts)


def test_nonterminals_are_looked_at_once():
    g = R.Grammar([i % 97 for i in range(97 * 64)])
    assert len(g.length) < 97 * 2 + 20  # words, pairs of a period, doublings
    g = R.Grammar(list(range(5000)) * 4)
    assert sum(g.length) < 20_000 * 20  # shallow: expansions add up to n log n


def expected(doc_id, text):
    parts = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(parts), h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        parts = [parts[i] if i < a else parts[a + (i - a) % p] for i in range(n)]
    found = brute(parts) if n < 3000 else R.runs_of(parts)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    return (len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(parts) if i not in gone)).hexdigest())


def test_documents(spark):
    given = rows() + [(1000 + i, " ".join(f"w{k % (9 + i)}" for k in range(60 + i)), "en", "x", 1)
                      for i in range(120)]
    got = {(r.doc_id, r.runs_sha256, r.collapsed_sha256): tuple(r)[1:]
           for r in R.periodic_runs(documents(spark, given), loop=True).collect()}
    want = {(d, e[-2], e[-1]): e for d, e in ((r[0], expected(r[0], r[1])) for r in given)}
    assert got == want
    assert any(v[0] for v in got.values())


def test_table_of_runs_and_empty_table(spark):
    docs = documents(spark)
    found = {(r.doc_id, r.start, r.length, r.period) for r in R.runs_table(docs).collect()}
    assert (405, 0, 120, 3) in found
    assert R.periodic_runs(docs.limit(0)).count() == 0
