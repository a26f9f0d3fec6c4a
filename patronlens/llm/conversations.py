"""Conversation structure repair: the cheapest edits that give every conversation the form
(system? (user assistant)+)?, by weighted interval parsing over its rows.

The grammar is in Chomsky normal form. A nonterminal stands for what takes a conversation
from one state to another (nothing yet, after the system turn, after a user, after an
assistant): X_pr -> X_pq X_qr, with one terminal rule per edit of a row, and all cells closed
under insertions. A cell holds the least (cost, audit) of each nonterminal over a span of
rows; cells are combined bottom-up by span length. As every state has a nonterminal to every
state it can reach, each derivation can be cut between any two rows, so all splits of a span
give the same minimum: one split per span, into spans of powers of two, is enough, and n rows
need n cells in place of n * n / 2. The least audit of a span is made of least audits of its
parts, because equally cheap audits of the same rows are never prefixes of each other.

Rows are put in order by ranges of (conversation, turn), so a conversation with a third of all
rows lies in many tasks; each task parses its stretches, and only their cells (a row per 1,024
rows) meet by conversation. Texts are joined to the edits afterwards and are never sorted.

Defined cases: null role or text is one space; null turns come first; rows of one turn are
ordered by role, then by the SHA-256 of their text; rows that repeat everything are one row with a
number of copies. A null conv_id is a conversation of its own. A role without a first letter
(empty) or with another one than s, u, a cannot be kept. An empty table gives no rows. Other
columns are ignored."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from patronlens.llm import common

# Costs of the edits, legal neighbours, separators of words.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
SPACES = " \t\n\x0b\x0c\r"

SEGMENT_LINES = 1024
ROLE = {"u": "user", "a": "assistant"}

# States: b nothing yet, s after the system turn, u and a after a user or assistant.
PAIRS = ("bb", "bs", "bu", "ba", "ss", "su", "sa", "uu", "ua", "au", "aa")
_AT = {pair: i for i, pair in enumerate(PAIRS)}
RULES = [[(_AT[p + q], _AT[q + r]) for q in "bsua" if p + q in _AT and q + r in _AT]
         for p, r in PAIRS]
_NEXT = {"b": "u", "s": "u", "u": "a", "a": "u"}  # the only state that an insertion leads to

Cell = tuple  # of (cost, audit) or None for each pair


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjoining spans: for every nonterminal the least over its rules."""
    out = []
    for rules in RULES:
        best = None
        for i, j in rules:
            x, y = left[i], right[j]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is None or cost <= best[0]:
                found = (cost, x[1] + y[1])
                best = found if best is None else min(best, found)
        out.append(best)
    return tuple(out)


def _cell(entries: Iterable[tuple[str, int, str]]) -> Cell:
    out: list = [None] * len(PAIRS)
    for pair, cost, audit in entries:
        found = (cost, audit)
        out[_AT[pair]] = found if out[_AT[pair]] is None else min(out[_AT[pair]], found)
    return tuple(out)


def _insertions() -> Cell:
    found = []
    for state in "bsua":
        found += [(state + state, 0, ""), (state + _NEXT[state], INSERT, "I")]
        twice = _NEXT[_NEXT[state]]
        if twice != state:
            found.append((state + twice, 2 * INSERT, "II"))
    return _cell(found)


INSERTIONS = _insertions()


def _row(initial: str, must_go: bool, unfinished: bool) -> Cell:
    """The cell of one row: all its edits, closed under insertions on both sides."""
    edits = [(state + state, DELETE, "D") for state in "bsua"]
    if not must_go:
        more = UNFINISHED if unfinished else 0
        for pair in ("bu", "su", "au", "ua"):
            edits.append((pair, REROLE + more, "R"))
            if pair[1] == initial:
                edits.append((pair, more, "K"))
        if initial == "s":
            edits.append(("bs", more, "K"))
    return combined(combined(INSERTIONS, _cell(edits)), INSERTIONS)


LEAVES = {key: _row(*key) for key in itertools.product(("s", "u", "a", ""), (False, True), (False, True))}


def leaf(initial: str, must_go: bool, unfinished: bool) -> Cell:
    return LEAVES[initial if initial in ("s", "u", "a") else "", must_go, unfinished]


def deletions(n: int) -> Cell:
    """The cell of n rows that must go; insertions sort after deletions of the same cost."""
    return tuple(e and (n * DELETE + e[0], "D" * n + e[1]) for e in INSERTIONS)


class Spans:
    """Cells of adjoining spans, combined as soon as two neighbours have the same length."""

    def __init__(self) -> None:
        self.stack: list[tuple[int, Cell]] = []

    def add(self, cell: Cell, length: int = 1) -> None:
        self.stack.append((length, cell))
        while len(self.stack) > 1 and self.stack[-2][0] <= self.stack[-1][0]:
            (n, right), (m, left) = self.stack.pop(), self.stack.pop()
            self.stack.append((m + n, combined(left, right)))

    def whole(self) -> Cell:
        cell = INSERTIONS
        for _, left in reversed(self.stack):
            cell = combined(left, cell)
        return cell


# ------------------------------------------------------------------ rows in order


def _digest(*parts: Column) -> Column:
    marked = [F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]
    return F.unhex(F.sha2(F.concat_ws("\x00", *marked), 256))


def _lines(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"))
    return rows.withColumn("text_sha", F.unhex(F.sha2("text", 256))).withColumn(
        "line", _digest(F.col("conv_id"), F.col("turn"), F.col("role"), F.hex("text_sha")))


def _judged(lines: DataFrame) -> DataFrame:
    """Distinct rows without texts: how many copies, and each one's fault."""
    core = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = (lines.withColumn("blank", F.length(core) == 0)
            .withColumn("open", ~F.coalesce(F.substring(core, -1, 1).isin(".", "!", "?"), F.lit(False)))
            .groupBy("line", "conv_id", "turn", "role", "text_sha", "blank", "open")
            .agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("same", _digest(F.col("conv_id"), F.col("role"), F.hex("text_sha"))))
    first = (rows.groupBy("same").agg(F.min("turn").alias("first_turn"),
                                      F.max(F.col("turn").isNull()).alias("from_null"),
                                      F.count(F.lit(1)).alias("turns"))
             .where("turns > 1").drop("turns"))  # only what recurs in another turn
    again = F.when(F.col("from_null"), F.col("turn").isNotNull()).otherwise(
        F.col("turn") > F.col("first_turn"))
    return rows.join(first, "same", "left").select(
        "conv_id", "turn", "role", "text_sha", "line", "copies", "blank", "open",
        F.coalesce(again, F.lit(False)).alias("again"))


_COUNTS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")
_EDGES = "first_turn long, last_turn long, first_initial string, last_initial string"


def _summed(parts: Iterable[dict]) -> dict:
    """Counts of adjoining parts: sums, and what their borders add or take."""
    total: dict | None = None
    for part in parts:
        if total is None:
            total = dict(part)
            continue
        for name in _COUNTS:
            total[name] += part[name]
        total["illegal"] += total["last_initial"] + part["first_initial"] not in LEGAL
        if part["last_turn"] is not None:
            total["turns"] -= total["last_turn"] == part["first_turn"]
            if total["first_turn"] is None:
                total["first_turn"] = part["first_turn"]
            total["last_turn"] = part["last_turn"]
        total["last_initial"] = part["last_initial"]
    return total


def _one(row: dict) -> tuple[dict, Cell]:
    """Counts and cell of a row with its copies."""
    copies, blank, again = row["copies"], row["blank"], row["blank"] or row["again"]
    initial, late = row["role"][:1], row["open"] and not again
    counts = {"rows": copies, "blank": copies if blank else 0,
              "duplicate": 0 if blank else copies - 1 + (1 if again else 0),
              "truncated": int(late), "illegal": copies - 1,
              "turns": int(row["turn"] is not None), "first_turn": row["turn"],
              "last_turn": row["turn"], "first_initial": initial, "last_initial": initial}
    cell = leaf(initial, again, late)
    return counts, cell if copies == 1 else combined(cell, deletions(copies - 1))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of at most SEGMENT_LINES rows of one conversation, each with its cell."""
    task, serial = TaskContext.get().partitionId(), 0
    held: list[dict] = []
    done: list[dict] = []

    def close() -> None:
        nonlocal held, serial
        spans, parts = Spans(), []
        for row in held:
            counts, cell = _one(row)
            spans.add(cell)
            parts.append(counts)
        cell = spans.whole()
        done.append(_summed(parts) | {
            "conv_id": held[0]["conv_id"], "segment": (task << 36) + serial,
            "costs": [e[0] if e else None for e in cell],
            "audits": [e[1] if e else None for e in cell],
            "lines": [{"line": r["line"], "copies": r["copies"]} for r in held]})
        held, serial = [], serial + 1

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if held and (len(held) == SEGMENT_LINES or held[-1]["conv_id"] != row["conv_id"]):
                close()
            held.append(row)
        if done:
            yield _segment_batch(done, kind)
            done = []
    if held:
        close()
        yield _segment_batch(done, kind)


_SEGMENT = ("segment long, rows long, blank long, duplicate long, truncated long, illegal long, "
            f"turns long, {_EDGES}, costs array<long>, audits array<string>, "
            "lines array<struct<line: binary, copies: long>>")


def _segment_batch(rows: list[dict], kind: pa.DataType) -> pa.RecordBatch:
    long, text = pa.int64(), pa.string()
    fields = [("conv_id", kind), ("segment", long), *((n, long) for n in _COUNTS),
              ("first_turn", long), ("last_turn", long), ("first_initial", text),
              ("last_initial", text), ("costs", pa.list_(long)), ("audits", pa.list_(text)),
              ("lines", pa.list_(pa.struct([("line", pa.binary()), ("copies", long)])))]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))


# ------------------------------------------------------------------ whole conversations


def _pieces(audit: str, sizes: Iterable[int]) -> Iterator[str]:
    """The part of the audit that belongs to each segment: its rows' letters with the
    insertions that follow them, for the first segment also those in front."""
    at = 0
    for size in sizes:
        begin = at
        while size:
            size -= audit[at] != "I"
            at += 1
        while at < len(audit) and audit[at] == "I":
            at += 1
        yield audit[begin:at]


_SOLVED = {"segment": "long", "before": "long", "with_system": "boolean", "piece": "string",
           "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long",
           "illegal": "long", "cost": "long", "audit": "string"}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Combines the cells of a conversation's segments and deals the audit out to them; its
    first row also carries the conversation's figures."""
    held: list[tuple[int, dict]] = []
    spans = Spans()
    conv: object = None
    done: list[dict] = []

    def close() -> None:
        nonlocal held, spans
        whole = spans.whole()
        cost, audit = min(e for e in (whole[_AT["bb"]], whole[_AT["ba"]]) if e)
        total = _summed(counts for _, counts in held)
        outputs = len(audit) - audit.count("D")
        gaps = (total["last_turn"] - total["first_turn"] + 1 - total["turns"]
                if total["turns"] else 0)
        head = {n: total[n] for n in ("blank", "duplicate", "truncated", "illegal")}
        head |= {"gaps": gaps, "cost": cost, "audit": audit}
        before = 0
        for (segment, _), piece in zip(held, _pieces(audit, [c["rows"] for _, c in held])):
            done.append({"conv_id": conv, "segment": segment, "before": before, "piece": piece,
                         "with_system": outputs % 2 == 1} | head)
            before += len(piece) - piece.count("D")
            head = dict.fromkeys(head)
        held, spans = [], Spans()

    schema = None
    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type),
                                *((name, _ARROW[kind]) for name, kind in _SOLVED.items())])
        for row in batch.to_pylist():
            if held and conv != row["conv_id"]:
                close()
            conv = row["conv_id"]
            costs, audits = row.pop("costs"), row.pop("audits")
            spans.add(tuple(None if c is None else (c, a) for c, a in zip(costs, audits)),
                      row["rows"])
            held.append((row["segment"], row))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if held:
        close()
        yield pa.RecordBatch.from_pylist(done, schema=schema)


_EDITS = "segment long, at long, edit string, role string, line binary"


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the repaired conversation; kept ones take their role from the input."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("conv_id", "segment", "at", "edit", "role", "line")}
        for row in batch.to_pylist():
            lines, copies, line = iter(row["lines"]), 0, None
            n, shift = row["before"], int(row["with_system"])
            for at, letter in enumerate(row["piece"]):
                if letter != "I":
                    if copies:
                        copies -= 1
                    else:
                        line, copies = (x := next(lines))["line"], x["copies"] - 1
                if letter == "D":
                    continue
                role = None if letter == "K" else ROLE["ua"[(n - shift) % 2]]
                for name, value in (("conv_id", row["conv_id"]), ("segment", row["segment"]),
                                    ("at", at), ("edit", letter), ("role", role),
                                    ("line", None if letter == "I" else line)):
                    out[name].append(value)
                n += 1
        kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.string(),
                 pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def _with_id(conversations: DataFrame, ddl: str) -> T.StructType:
    first = T.StructField("conv_id", conversations.schema["conv_id"].dataType)
    return T.StructType([first, *T.StructType.fromDDL(ddl).fields])


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two frames. Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit. And the repaired rows: conv_id, segment and at (their order), edit (K kept,
    R with another role, I inserted), role, text.

    An input has conv_id, turn, role, text."""
    lines = _lines(conversations)
    ordered = _judged(lines).select(
        "conv_id", "turn", "role", "text_sha", "line", "copies", "blank", "open", "again")
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text_sha")]
    segments = common.staged(
        ordered.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_segments, _with_id(conversations, _SEGMENT)), "segments")
    solved = common.staged(
        segments.drop("lines").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
        .mapInArrow(_solve, _with_id(
            conversations, ", ".join(f"{n} {kind}" for n, kind in _SOLVED.items()))), "solved")
    edits = (segments.select("conv_id", "segment", "lines")
             .join(solved.select("segment", "before", "with_system", "piece"), "segment")
             .mapInArrow(_edits, _with_id(conversations, _EDITS)))
    edits = common.staged(edits, "edits")
    common.unstage(segments)
    texts = lines.groupBy("line").agg(F.any_value("role").alias("own_role"),
                                      F.any_value("text").alias("text"))
    named = edits.where("line IS NOT NULL").join(texts, "line").select(
        "conv_id", "segment", "at", "edit",
        F.coalesce("role", "own_role").alias("role"), "text")
    inserted = edits.where("line IS NULL").select(
        "conv_id", "segment", "at", "edit", "role", F.lit("").alias("text"))
    found = solved.where("audit IS NOT NULL").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return found, named.unionByName(inserted)


# ------------------------------------------------------------------ the query


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the checksum of `conv_id:turn` asks for."""
    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat_ws(":", said("conv_id"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"),
                                said("text").alias("text"), fault.alias("fault"))
    text = (F.when(F.col("fault") == 1, F.lit(""))
            .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.where("fault <> 0").withColumn("_copy", F.explode(copies)).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"))


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by conversation, kind and place: the conversation's own row, its figures, its
    repaired rows, which are hashed as they pass."""
    state: dict | None = None
    started = False
    done: list[dict] = []
    schema = None

    def closed() -> dict:
        state["repaired_sha256"] = state["repaired_sha256"].hexdigest()
        return state

    for batch in batches:
        if schema is None:
            schema = pa.schema([("conv_id", batch.schema.field("conv_id").type),
                                *((n, pa.int64()) for n in _FIGURES),
                                ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for row in batch.to_pylist():
            if state is None or state["conv_id"] != row["conv_id"]:
                if state is not None:
                    done.append(closed())
                state = {"conv_id": row["conv_id"], "audit": "", **dict.fromkeys(_FIGURES, 0),
                         "repaired_sha256": hashlib.sha256()}
                started = False
            if row["kind"] == 1:
                state.update({n: row[n] for n in (*_FIGURES, "audit")})
            elif row["kind"] == 2:
                said = f"{row['role']}:{row['text']}"
                state["repaired_sha256"].update(("\n" + said if started else said).encode())
                started = True
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if state is not None:
        yield pa.RecordBatch.from_pylist([closed()], schema=schema)


def reported(conversations: DataFrame, found: DataFrame, repaired: DataFrame) -> DataFrame:
    """A row for every conv_id of `conversations`: the figures and the SHA-256 of the
    repaired rows as `role:text` lines, read as a stream."""
    ids = conversations.select("conv_id").distinct().select("conv_id", F.lit(0).alias("kind"))
    parts = ids.unionByName(found.withColumn("kind", F.lit(1)), allowMissingColumns=True).unionByName(
        repaired.drop("edit").withColumn("kind", F.lit(2)), allowMissingColumns=True)
    order = ("conv_id", "kind", "segment", "at")
    ddl = ", ".join(f"{n} long" for n in _FIGURES) + ", audit string, repaired_sha256 string"
    return (parts.repartition("conv_id").sortWithinPartitions(*order)
            .mapInArrow(_digests, _with_id(conversations, ddl)))


def op11_conversation_repair(spark, sf_dir):
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found, repaired = repair(damaged(given))
    return reported(given, found, repaired)


# The same edits by a walk over the states from the first row to the last.
SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':'
                                       || coalesce(turn::VARCHAR, ' '), ''),
                          lambda x: ascii(x)::BIGINT) AS bytes
    FROM conversations),
faulty AS (
    SELECT conv_id, turn, role, text,
           xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b:
               xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
    FROM keyed, crc),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                      ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM faulty WHERE fault <> 0),
numbered AS (
    SELECT *, row_number() OVER w AS i, left(role, 1) AS ini,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1
               AS again,
           rtrim(text, E' \t\n\x0b\x0c\r') AS core,
           lag(left(role, 1)) OVER w AS before
    FROM damaged
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
judged AS (
    SELECT *, core = '' AS blank, core <> '' AND again AS duplicate,
           core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated
    FROM numbered),
figures AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal,
           max(i) AS n
    FROM judged GROUP BY conv_id),
inserts(p, q, c, a, said) AS (VALUES
    ('b', 'b', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('b', 'u', 5, 'I', E'user:\n'), ('s', 'u', 5, 'I', E'user:\n'),
    ('a', 'u', 5, 'I', E'user:\n'), ('u', 'a', 5, 'I', E'assistant:\n'),
    ('b', 'a', 10, 'II', E'user:\nassistant:\n'), ('s', 'a', 10, 'II', E'user:\nassistant:\n')),
moves(p, q) AS (VALUES ('b', 's'), ('b', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
edits AS (
    SELECT conv_id, i, p, p AS q, 2 AS c, 'D' AS a, '' AS said
    FROM judged, (VALUES ('b'), ('s'), ('u'), ('a')) t(p)
    UNION ALL
    SELECT conv_id, i, p, q, CASE WHEN truncated THEN 5 ELSE 0 END, 'K', role || ':' || text || E'\n'
    FROM judged JOIN moves ON q = ini WHERE NOT blank AND NOT duplicate
    UNION ALL
    SELECT conv_id, i, p, q, CASE WHEN truncated THEN 6 ELSE 1 END, 'R',
           CASE q WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text || E'\n'
    FROM judged JOIN moves ON q <> 's' WHERE NOT blank AND NOT duplicate),
steps AS (
    SELECT conv_id, 0::BIGINT AS i, q AS st, {'c': c::BIGINT, 'a': a, 'said': said} AS best
    FROM figures, inserts WHERE p = 'b'
    UNION ALL
    SELECT conv_id, i, st, min(found) AS best FROM (
        SELECT steps.conv_id, edits.i, inserts.q AS st,
               {'c': best.c + edits.c + inserts.c, 'a': best.a || edits.a || inserts.a,
                'said': best.said || edits.said || inserts.said} AS found
        FROM steps JOIN edits ON edits.conv_id IS NOT DISTINCT FROM steps.conv_id
                              AND edits.i = steps.i + 1 AND edits.p = steps.st
                   JOIN inserts ON inserts.p = edits.q)
    GROUP BY conv_id, i, st),
solved AS (
    SELECT figures.conv_id, min(best) AS best
    FROM steps JOIN figures ON figures.conv_id IS NOT DISTINCT FROM steps.conv_id
                            AND steps.i = figures.n
    WHERE st IN ('b', 'a') GROUP BY figures.conv_id)
SELECT given.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit,
       sha256(coalesce(best.said[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) given
LEFT JOIN figures ON figures.conv_id IS NOT DISTINCT FROM given.conv_id
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM given.conv_id
"""
