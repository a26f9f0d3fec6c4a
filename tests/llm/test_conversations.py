"""Conversation repair against its SQL form and against all edits tried one by one."""

import itertools
import random
import re

import duckdb
import pytest

from compare import differences
from patronlens.llm import conversations as C

SCHEMA = ("conv_id long, turn long, role string, text string, line string, copies long, "
          "segment long, kind int, at long, same string")
TEXTS = ["Fine.", "cut off", "", " \t", "Why?", None, "Go! ", "...", "no\nend\x0b", "é.", "ſ "]


def rows():
    rng = random.Random(7)
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            out.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 2, 2, 40]),
                        rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
                        rng.choice(TEXTS) if rng.random() < 0.5 else f"Said {turn}."))
    out += [(1000, t, "user" if t % 2 else "assistant", f"Long {t % 37}.") for t in range(90)]
    out += [(1001, 3, "user", "Copy.")] * 50 + [(1002, None, None, None)]
    return out


def frame(spark, found):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, "y") for r in found], SCHEMA).repartition(3)


def by_sql(found):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if found:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", found)
    return con


def query(given):
    found, repaired = C.repair(C.damaged(given))
    return C.reported(given, found, repaired)


@pytest.mark.parametrize("length", [1024, 3])
def test_matches_sql(spark, monkeypatch, length):
    monkeypatch.setattr(C, "SEGMENT_LINES", length)  # long conversations lie in many segments
    found = rows()
    assert differences(query(frame(spark, found)), by_sql(found), C.SQL) is None


def test_empty_table(spark):
    assert query(frame(spark, rows()).limit(0)).count() == 0


def test_only_dropped_rows(spark):
    import zlib
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = query(frame(spark, [(gone, 0, "user", "Hi.")])).collect()[0]
    assert (got.cost, got.audit, got.gaps) == (0, "", 0)
    assert got.repaired_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def every_edit(initials, must_go, late):
    """The cheapest audit among all sequences of edits with at most two insertions a gap."""
    best = None
    fills = ["", "u", "a", "ua", "au"]
    choices = []
    for ini, go, open_ in zip(initials, must_go, late):
        more = 5 if open_ else 0
        choices.append([("D", 2, "")] + ([] if go else [("K", more, ini), ("R", 1 + more, "u"),
                                                       ("R", 1 + more, "a")]))
    for edits in itertools.product(*choices):
        for gaps in itertools.product(fills, repeat=len(edits) + 1):
            said = gaps[0] + "".join(e[2] + g for e, g in zip(edits, gaps[1:]))
            if re.fullmatch("(s?(ua)+)?", said):
                cost = 5 * sum(map(len, gaps)) + sum(e[1] for e in edits)
                audit = "I" * len(gaps[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, gaps[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_spans_against_all_edits():
    rng = random.Random(3)
    for _ in range(60):
        n = rng.randint(0, 4)
        rows = [(rng.choice("suaut"), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]
        spans = C.Spans()
        for ini, go, late in rows:
            spans.add(C.leaf(ini, go, late and not go))
        whole = spans.whole()
        found = min(e for e in (whole[C.PAIRS.index("bb")], whole[C.PAIRS.index("ba")]) if e)
        assert found == every_edit([r[0] for r in rows], [r[1] for r in rows],
                                   [r[2] and not r[1] for r in rows])


def test_every_split_of_a_span_gives_the_same_cell():
    rng = random.Random(5)
    for _ in range(40):
        cells = [C.leaf(rng.choice("suat"), rng.random() < 0.2, False) for _ in range(7)]
        chart = {(i, i + 1): c for i, c in enumerate(cells)}
        for length in range(2, 8):
            for i in range(8 - length):
                found = {C.combined(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)}
                assert len(found) == 1
                chart[i, i + length] = found.pop()


def test_repaired_rows_have_the_form(spark):
    _, repaired = C.repair(frame(spark, rows()))
    by = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.segment, r.at)):
        by[r.conv_id] = by.get(r.conv_id, "") + r.role[0]
    assert by and all(re.fullmatch("s?(ua)+", x) for x in by.values())
