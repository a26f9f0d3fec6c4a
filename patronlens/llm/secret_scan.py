"""Secret scan: patterns, and strings in a sensitive context that do not compress.

Three patterns give the base spans: assignments to names such as password or token, access
keys, long hexadecimal numbers. Beyond them, every string of at least CANDIDATE bytes with
letters and digits that follows a sensitive word on its line is measured: zstandard, primed
with a dictionary of the corpus' most frequent identifiers, compresses the text around the
string once without and once with it. The difference is what the string adds. Names and prose
are made of what the dictionary and the surroundings already hold and add little; a string
that adds NOVELTY bytes per byte or more is reported as `novel`, unless it touches a base span.

The identifiers are counted over all documents (each task counts what it reads before anything
is shuffled); the dictionary keeps the most frequent ones up to DICTIONARY bytes, a bounded
parameter of the measure that reaches workers with the task. The scan itself moves no rows.

Defined cases: a null text is empty; documents without doc_id are scanned like others; repeated
rows give repeated results; a very long text is scanned whole; copies of a string in its own
surroundings do not make it less novel; an empty table gives no rows and an empty dictionary;
other columns are ignored."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from patronlens.llm import common, words

# The base patterns (on bytes; the first one on lower-cased ones), the least
# lengths of the second group of `assign` and of the other matches.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    rb"([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
ASSIGN_BYTES, ACCESS_BYTES = 8, 16
KINDS = ("assign", "access", "hex", "novel")

# Words after which a string is looked at, and what counts as one.
SENSITIVE = re.compile(rb"pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key|credential|bearer|"
                       rb"authori[sz]ation|auth[_-]|(?:access|private|client|signing)[_-]?key")
CANDIDATE = 12
STRING = re.compile(rb"[A-Za-z0-9+/_=.~!@#$%%^&*-]{%d,}" % CANDIDATE)
REACH = 80  # bytes after the sensitive word in which the string begins
AROUND = 512  # bytes on each side that prime the compressor
NOVELTY, HEX_NOVELTY = 0.85, 0.6  # added bytes per byte; a hexadecimal digit holds half a byte
DICTIONARY = 32 * 1024
LEVEL = 19  # quicker levels choose other matches with the string than without it

_HEXADECIMAL = re.compile(rb"[0-9a-fA-F-]+")
# Names without digits: a candidate has digits, so no secret can enter, however often copied.
_IDENTIFIER = re.compile(rb"(?<![0-9A-Za-z_])[A-Za-z_]{4,40}(?![0-9A-Za-z_])")
_HELD = 200_000  # distinct words that a task counts before it passes them on


# ------------------------------------------------------------------ identifiers


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        names: Counter = Counter()
        for word, n in counts.items():
            for name in _IDENTIFIER.findall(word):
                names[name] += n
        counts.clear()
        return pa.RecordBatch.from_pydict({"word": pa.array(list(names), pa.binary()),
                                           "n": pa.array(list(names.values()), pa.int64())})

    for batch in batches:
        for text in words.text_bytes(batch.column("text")):
            for at, end in words.slices(text):
                counts.update(text[at:end].split())
                if len(counts) > _HELD:
                    yield flushed()
    yield flushed()


def identifier_dictionary(docs: DataFrame, size: int = DICTIONARY) -> bytes:
    """The most frequent identifiers of all documents, rarest first, in at most `size` bytes."""
    counted = docs.select("text").mapInArrow(_count, "word binary, n long")
    top = (counted.groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(size // 5 + 1))  # words have 4 bytes and a space
    with common.tidy_shuffles(docs.sparkSession):
        found = common.fetched(top)
    out: list[bytes] = []
    left = size
    for word in found["word"]:
        left -= len(word) + 1
        if left < 0:
            break
        out.append(bytes(word))
    return b" ".join(reversed(out))


# ------------------------------------------------------------------ spans of one text


def base_spans(data: bytes, lower: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns, in bytes."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(lower)
             if m.end(1) - m.start(1) >= ASSIGN_BYTES]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(data)
              if m.end() - m.start() >= ACCESS_BYTES]
    return found + [(m.start(), m.end(), 2) for m in HEX.finditer(data)]


def strings_in_context(data: bytes, lower: bytes) -> Iterator[tuple[int, int]]:
    """Begin and end of each candidate once, in order."""
    passed = 0
    for word in SENSITIVE.finditer(lower):
        at = word.end()
        until = data.find(b"\n", at, at + REACH)
        until = at + REACH if until < 0 else until
        for m in STRING.finditer(data, max(at, passed)):
            if m.start() >= until:
                break
            passed = m.end()
            string = m.group().lower()
            if not string.isdigit() and any(48 <= c <= 57 for c in string) and re.search(
                    rb"[a-z]", string):
                yield m.start(), m.end()


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    given = {}
    if dictionary:
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        given = {"dict_data": primed}
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False,
                                    write_dict_id=False, **given)


def added_bytes(data: bytes, start: int, end: int, coder: zstandard.ZstdCompressor) -> int:
    """Compressed bytes that data[start:end] adds to its surroundings."""
    string = data[start:end]
    around = (data[max(0, start - AROUND):start] + data[end:end + AROUND]).replace(string, b"")
    return len(coder.compress(around + b" " + string)) - len(coder.compress(around + b" "))


def spans(data: bytes, coder: zstandard.ZstdCompressor) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all findings in code points, by start, then kind."""
    lower = words.lower_ascii(data)
    found = base_spans(data, lower)
    base = list(found)
    for start, end in strings_in_context(data, lower):
        if any(a < end and start < b for a, b, _ in base):
            continue
        least = HEX_NOVELTY if _HEXADECIMAL.fullmatch(data, start, end) else NOVELTY
        if added_bytes(data, start, end, coder) >= least * (end - start):
            found.append((start, end, 3))
    if not found or data.isascii():
        return sorted(found, key=lambda s: (s[0], s[2]))
    points, at, n = {}, 0, 0
    for place in sorted({p for s in found for p in s[:2]}):
        n += len(data[at:place].decode("utf-8", "replace"))
        points[place], at = n, place
    return sorted(((points[a], points[b], k) for a, b, k in found), key=lambda s: (s[0], s[2]))


# ------------------------------------------------------------------ documents


_KIND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = compressor(dictionary)
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans(text, coder)]
                     for text in words.text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, _KIND)],
                                             names=["doc_id", "found"])

    return run


def secrets(docs: DataFrame, dictionary: bytes | None = None) -> DataFrame:
    """Per document: doc_id and found, its findings as structs of kind, start and end (code
    points, end exclusive). The dictionary is made of `docs` where none is given."""
    if dictionary is None:
        dictionary = identifier_dictionary(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(_scan(dictionary), "doc_id long, found array<struct<kind: string, "
                            "start: long, end: long>>")


def op12_secret_scan(spark, sf_dir):
    found = secrets(common.table(spark, sf_dir, "documents"))

    def listed(some: str) -> Column:
        return F.expr(f"array_join(transform({some}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')")

    def number(kind: str) -> Column:
        return F.expr(f"cast(size(filter(found, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, KINDS[:3]),
                        F.sha2(listed("filter(found, x -> x.kind <> 'novel')"), 256).alias("base_sha256"),
                        listed("found").alias("spans"))
