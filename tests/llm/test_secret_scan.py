"""Secret scan: base spans against the patterns as written, novel strings planted in prose."""

import hashlib
import random
import re

from patronlens.llm import secret_scan as S

from .corpus import documents, rows

PATTERN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)


def base(text):
    """(start, kind number, end) by the patterns of the contract, on code points."""
    found = [(m.start(), 0, m.end()) for m in PATTERN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m.group()) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text)
                           if len(m.group()) >= 32])


PARTS = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "ſecret", "apiKey", ":", "=",
         " ", "  ", '"', "'", "\n", "é", "😀", "abc", "abcdefgh", "x" * 7, "x" * 8, "AKIA", "A" * 12,
         "Z9", "0123456789abcdef", "f" * 32, "DEADBEEF", "-", "/+", ".", "\t", "akia"]


def texts():
    rng = random.Random(11)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    return out + ["token=secret=abcdefgh", "token = api_key: abcdefghij", "AKIAAKIA" + "B" * 12,
                  "x" * 300_000 + " secret: abcdefgh " + "0" * 40]


def test_base_spans_on_any_text():
    coder = S.compressor(b"")
    for text in texts():
        found = [s for s in S.spans(text.encode(), coder) if s[2] < 3]
        assert [(a, k, b) for a, b, k in found] == base(text), text


def query(docs):
    return {r.doc_id: r for r in _derived(docs).collect()}


def _derived(docs):
    import unittest.mock as mock
    with mock.patch.object(S.common, "table", lambda *_: docs):
        return S.op12_secret_scan(docs.sparkSession, "")


def test_query_digests(spark):
    given = [(10_000 + i, t, "en", "web", 1) for i, t in enumerate(texts()[:300])] + [
        r for r in rows() if r[0] != 5]  # the id 5 has two texts
    found = query(documents(spark, given))
    for doc_id, text, *_ in given:
        spans = base(text or "")
        listed = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        r = found[doc_id]
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        rest = [s for s in r.spans.split(",") if s and not s.startswith("novel")]
        assert ",".join(rest) == listed


def test_novel_strings_are_reported_and_names_are_not(spark):
    rng = random.Random(5)
    prose = ["the service reads its configuration from the authentication server and retries"] * 30
    names = ["authentication_server2", "configuration2024", "service_retries_v2"]
    prose += [" ".join(names)] * 20
    planted, plain = {}, []
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for i in range(40):
        key = "".join(rng.choice(alphabet) for _ in range(24)) + "7a"
        planted[i] = (f"{prose[i % 50]} bearer {key} {prose[0]}", key)
    for i in range(40):
        plain.append(f"{prose[0]} use the credential {names[i % 3]} {prose[0]}")
    docs = spark.createDataFrame(
        [(i, t) for i, (t, _) in planted.items()] + [(100 + i, t) for i, t in enumerate(plain)]
        + [(200 + i, t) for i, t in enumerate(prose)] + [(300, f"{planted[0][1]} stands alone")],
        "doc_id long, text string")
    found = {r.doc_id: r.found for r in S.secrets(docs).collect()}
    for i, (text, key) in planted.items():
        assert [(f.kind, text[f.start:f.end]) for f in found[i]] == [("novel", key)]
    assert not any(found[i] for i in found if i >= 100)  # no sensitive word, or nothing new


def test_dictionary_counts_all_documents(spark):
    docs = spark.createDataFrame([(i, "common_name other " * 3) for i in range(50)]
                                 + [(99, "rare_name"), (100, None)], "doc_id long, text string")
    assert S.identifier_dictionary(docs) == b"rare_name other common_name"
    assert S.identifier_dictionary(docs, 12) == b"common_name"
    assert S.identifier_dictionary(docs.limit(0)) == b""


def test_empty_table(spark):
    assert query(documents(spark).limit(0)) == {}
