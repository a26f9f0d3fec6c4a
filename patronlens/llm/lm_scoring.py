"""Language-model scores from a log-frequency Bloom filter.

Word counts are exact: c over all training tokens gives the base probability
P0(w) = (c + 0.1) / (N + 0.1 (V + 1)). Counts of word pairs, quantised to powers of two, live in
a Bloom filter: a pair of level q is entered q times, as (pair, 1) to (pair, q). A reader probes
level after level until one is missing and takes the count that belongs to the last level. A
token after context h scores

    P(w | h) = M * n(h, w) / c(h) + (1 - M * s(h)) * P0(w)

where s(h) is the share of h's occurrences that the entered pairs cover; the probabilities of
all words after h sum to one, and a context without pairs leaves the base probability.

Every word and every pair of the training text enters, from count 1. Words and pairs are dealt
by their hash to lanes, whose number grows with the text; a lane's filter has `BITS_PER_ENTRY`
bits for each of its own entries. One pass counts both in chunks of about `CHUNK` tokens, so a
hot word or pair sends one entry per chunk; a lane of pairs adds them up, becomes a filter at
once and passes on what its pairs cover of each context. Inside a lane a pair is known by 32
bits of its hash: among two million pairs a stranger meets one of them with a probability of
0.0005, small beside the filter's own errors (about 0.01). Nothing is broadcast: documents are
taken together in groups of about `GROUP` tokens, a group asks each lane once for its distinct
words and pairs, and the answers meet the group's tokens by a shuffle.

Defined cases: null text is empty and scores its end token alone; a document without doc_id
counts as held out; without training documents N and V are 0 and every token has the base
probability 1; repeated rows are counted and scored each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from patronlens.llm import common, words

FOLDS = 10
LANES, LANE_BYTES = 512, 1 << 23  # lanes at least, training text for each beyond
PARTITION_BYTES = 1 << 25  # of text, for each partition of a shuffle
BITS_PER_ENTRY = 10
_SEGMENT_BITS = 1 << 12  # the probes of a key stay inside a segment
PROBES = 4
SHARE = 0.7  # M: weight of the pair counts
END = np.uint64(0x2545F4914F6CDD1D)  # the hash of the end token
CHUNK = 1_000_000
GROUP = 1 << 19
BLOCK = 1 << 17  # keys that are hashed or probed at once
ROWS, ASKED_ROWS = 128, 512  # of an Arrow batch: of texts and chunks, of what lanes are asked
TOKENS, WORDS, PAIRS, COVERED = 0, 1, 2, 3  # kinds of rows


def tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The hashes of each text's lower-cased words and its end."""
    texts = (words.lower_ascii(t) for t in words.text_bytes(batch.column("text")))
    for hashes in words.hashes_of(texts):
        yield np.append(hashes, END)


def pair_keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return words.mix(words.mix(h + np.uint64(1)) + w * np.uint64(0x9E3779B97F4A7C15))


def lane_of(keys: np.ndarray, lanes: int) -> np.ndarray:
    """Ranges of the hash, so that sorted keys are sorted by lane as well."""
    return ((keys >> np.uint64(32)) * np.uint64(lanes) >> np.uint64(32)).astype(np.int32)


def in_lane(keys: np.ndarray) -> np.ndarray:
    """What a pair is called inside its lane."""
    return keys.astype(np.uint32)


def _by_lane(keys: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lanes that sorted keys fall into, and where each begins and ends."""
    found, first = np.unique(lane_of(keys, lanes), return_index=True)
    return found, first, np.append(first[1:], len(keys))


# --- counting ----------------------------------------------------------------------------

def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each distinct one of sorted keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])


def _summed(keys: np.ndarray, n: np.ndarray | None, h: np.ndarray | None):
    """Distinct keys in order, the sum of each one's counts (or how often it occurs) and its
    context."""
    if n is None and h is None:
        keys = np.sort(keys)
        first = _firsts(keys)
        return keys[first], np.diff(np.append(first, len(keys))), None
    order = np.argsort(keys)
    keys = keys[order]
    first = _firsts(keys)
    if n is None:
        total = np.diff(np.append(first, len(keys)))
    else:
        total = np.add.reduceat(n[order], first) if len(first) else n
    return keys[first], total, None if h is None else h[order[first]]


def _cut(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of adjoining parts of an array, not copied."""
    cuts = (np.append(begin[:1], end) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(end),
                                 [None, pa.py_buffer(cuts), pa.py_buffer(values)])


_COUNTED = "kind int, lane int, keys binary, n binary, h binary"


def _counted(lanes: int):
    """Counts of the words and pairs of each chunk of tokens, a row for each lane."""

    def rows(kind: int, keys, n, h) -> pa.RecordBatch:
        found, begin, end = _by_lane(keys, lanes)
        return pa.RecordBatch.from_pydict({
            "kind": pa.array([kind] * len(found), pa.int32()), "lane": pa.array(found),
            "keys": _cut(keys if kind == WORDS else in_lane(keys), begin, end),
            "n": _cut(n.astype(np.uint32), begin, end),
            "h": pa.array([b""] * len(found), pa.binary()) if h is None else _cut(h, begin, end)})

    def chunk(held: list[np.ndarray], overlaps: list[bool]) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(held)
        last = np.cumsum([len(x) for x in held]) - 1
        held.clear()
        yield rows(WORDS, *_summed(np.delete(flat, last[np.array(overlaps)]), None, None))
        follows = np.ones(len(flat), bool)
        follows[last] = False  # nothing follows the last token of a text
        h = flat[follows]
        if len(h):
            follows = np.roll(follows, 1)  # the tokens that have one before them
            w = flat[follows]
            del flat, follows
            for at in range(0, len(h), BLOCK):  # a pair's key takes the place of its token
                w[at:at + BLOCK] = pair_keys(h[at:at + BLOCK], w[at:at + BLOCK])
            yield rows(PAIRS, *_summed(w, None, h))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, overlaps, size = [], [], 0
        for batch in batches:
            for hashes in tokens(batch):
                for at in range(0, len(hashes), CHUNK):  # parts of a long text share a token
                    held.append(hashes[at:at + CHUNK + 1])
                    overlaps.append(at + CHUNK < len(hashes))
                    size += len(held[-1])
                    if size > CHUNK:
                        yield from chunk(held, overlaps)
                        held, overlaps, size = [], [], 0
        if held:
            yield from chunk(held, overlaps)

    return run


# --- the filter --------------------------------------------------------------------------

def level(n):
    return np.floor(np.log2(n)).astype(np.int64) + 1


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count a level stands for: the middle of its powers of two, on a log scale."""
    return np.where(levels == 1, 1.0, 2.0 ** (levels - 0.5))


def probes(keys: np.ndarray, levels: np.ndarray | int,
           size: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each key in a filter of `size` bits, and the bits (one column per probe)
    inside it of one level."""
    h = words.mix(keys * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    segment = (h >> np.uint64(32)) % np.uint64(size // _SEGMENT_BITS)
    g = words.mix(h + np.asarray(levels).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    step = (g >> np.uint64(32)) | np.uint64(1)
    at = [(g + np.uint64(i) * step) % np.uint64(_SEGMENT_BITS) for i in range(PROBES)]
    return segment.astype(np.int64), np.stack(at, axis=1).astype(np.int64)


def _bits_at(keys: np.ndarray, q: int, size: int) -> np.ndarray:
    segment, at = probes(keys, q, size)
    return at + segment[:, None] * _SEGMENT_BITS


def filter_of(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The filter of these pairs, sized by the levels they enter."""
    levels = level(n)
    keys = keys.astype(np.uint64)
    segments = -(-int(levels.sum()) * BITS_PER_ENTRY // _SEGMENT_BITS)
    bits = np.zeros(segments * _SEGMENT_BITS, bool)
    for q in range(1, int(levels.max()) + 1):
        entered = keys[levels >= q]
        for at in range(0, len(entered), BLOCK):
            bits[_bits_at(entered[at:at + BLOCK], q, len(bits)).ravel()] = True
    return np.packbits(bits)


def levels_of(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The level found for each key by probing level after level."""
    if len(keys) > BLOCK:
        return np.concatenate([levels_of(keys[at:at + BLOCK], bits)
                               for at in range(0, len(keys), BLOCK)])
    out = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    q = 1
    while len(alive):
        at = _bits_at(keys[alive], q, len(bits) * 8)
        found = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1)
        alive = alive[found]
        out[alive] = q
        q += 1
    return out


_LANES = "kind int, lane int, batch long, data binary"


def _lane_row(kind: int, lane: int, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "kind": pa.array([kind], pa.int32()), "lane": pa.array([lane], pa.int32()),
        "batch": pa.array([-1], pa.int64()),
        "data": pa.array([b"".join(x.tobytes() for x in arrays)], pa.binary())})


def _lanes(lanes: int):
    """Chunks come by kind and lane. A lane of pairs gives its filter, a lane of words its
    counts; what pairs cover of their contexts is added up for many lanes of the task."""

    def closed(here: tuple[int, int], parts: list, covered: list) -> pa.RecordBatch:
        keys, n, h = _together(here[0], parts)
        if here[0] == WORDS:
            return _lane_row(WORDS, here[1], keys, n)
        covered.append((h, count_of(level(n))))
        return _lane_row(PAIRS, here[1], filter_of(keys, n))

    def cover(h: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lane, i, j in zip(*_by_lane(h, lanes)):
            yield _lane_row(COVERED, lane, h[i:j], n[i:j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, parts, size, covered = None, [], 0, []
        for batch in batches:
            for kind, lane, *data in zip(*(c.to_pylist() for c in batch.columns)):
                if (kind, lane) != here:
                    if here:
                        yield closed(here, parts, covered)
                    if sum(len(h) for h, _ in covered) > CHUNK:
                        covered = [_added(covered)]
                        if len(covered[0][0]) > CHUNK // 2:
                            yield from cover(*covered.pop())
                    here, parts, size = (kind, lane), [], 0
                of = np.uint64 if kind == WORDS else np.uint32
                parts.append((np.frombuffer(data[0], of),
                              np.frombuffer(data[1], np.uint32).astype(np.int64),
                              np.frombuffer(data[2], np.uint64)))
                size += len(parts[-1][0])
                if size > CHUNK:
                    parts = [_together(kind, parts)]
                    size = len(parts[0][0]) // 2  # merged again once as much is new
        if here:
            yield closed(here, parts, covered)
        if covered:
            yield from cover(*_added(covered))

    return run


def _added(covered: list) -> tuple[np.ndarray, np.ndarray]:
    return _summed(*(np.concatenate(x) for x in zip(*covered)), None)[:2]


def _together(kind: int, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, n, h = (np.concatenate(x) for x in zip(*parts))
    keys, n, h = _summed(keys, n, h if kind == PAIRS else None)
    return keys, n, np.zeros(0, np.uint64) if h is None else h


def _known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words come by lane, their counts first: one row of keys, counts and covered
    occurrences for each lane, with the sums over it."""

    def closed(lane: int, keys, n, covered) -> pa.RecordBatch:
        row = _lane_row(WORDS, lane, keys, n, covered)
        return pa.RecordBatch.from_pydict({
            **dict(zip(row.schema.names, row.columns)),
            "total": pa.array([int(n.sum())]), "distinct": pa.array([len(keys)])})

    here = None
    for batch in batches:
        for kind, lane, data in zip(*(batch.column(c).to_pylist()
                                      for c in ("kind", "lane", "data"))):
            half = len(data) // 2
            keys = np.frombuffer(data[:half], np.uint64)
            if kind == WORDS:  # a lane's contexts are words of it, so they never come alone
                if here:
                    yield closed(*here)
                here = lane, keys, np.frombuffer(data[half:], np.int64), np.zeros(len(keys))
            else:
                np.add.at(here[3], np.searchsorted(here[1], keys), np.frombuffer(data[half:]))
    if here:
        yield closed(*here)


def _bytes(texts: DataFrame) -> int:
    return int(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def _dealt(rows: DataFrame, size: int, by: list[str], order: list[str]) -> DataFrame:
    """Rows by these columns, in order; partitions grow with the `size` of the text."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-size // PARTITION_BYTES)
    dealt = rows.repartition(parts, *by) if parts > most else rows.repartition(*by)
    return dealt.sortWithinPartitions(*order)


def train(texts: DataFrame, lane_bytes: int = LANE_BYTES) -> tuple[dict, DataFrame]:
    """The model's sizes, and its lanes of words and pairs as a staged table."""
    size = _bytes(texts)
    lanes = max(LANES, -(-size // lane_bytes))
    by = ["kind", "lane"]
    parts = common.staged(_dealt(texts.select("text").mapInArrow(_counted(lanes), _COUNTED),
                                 size, by, by).mapInArrow(_lanes(lanes), _LANES), "lane-parts", ROWS)
    known = _dealt(parts.where(F.col("kind") != PAIRS), size, ["lane"], ["lane", "kind"])
    rows = (known.mapInArrow(_known, f"{_LANES}, total long, distinct long")
            .unionByName(parts.where(F.col("kind") == PAIRS), allowMissingColumns=True))
    out = common.staged(rows, "lanes", ASKED_ROWS)
    common.unstage(parts)
    total, distinct = out.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct"))).first()
    return ({"total": int(total), "distinct": int(distinct), "lanes": lanes},
            out.drop("total", "distinct"))


# --- scoring -------------------------------------------------------------------------------

_TOKENS = ("batch long, doc_ids array<long>, held array<boolean>, sizes array<int>, "
           "words binary, at binary")


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of documents as their distinct words, by lane, and each token's place there."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    schema = pa.schema([("batch", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                        ("words", pa.binary()), ("at", pa.binary())])

    def row(ids: list, held: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        known, at = np.unique(np.concatenate(texts), return_inverse=True)
        return pa.RecordBatch.from_pylist([{
            "batch": number, "doc_ids": ids, "held": held, "sizes": [len(t) for t in texts],
            "words": known.tobytes(), "at": at.astype(np.uint32).tobytes()}], schema=schema)

    ids, held, texts, size = [], [], [], 0
    for batch in batches:
        for doc_id, out, hashes in zip(batch.column("doc_id").to_pylist(),
                                       batch.column("held_out").to_pylist(), tokens(batch)):
            ids.append(doc_id)
            held.append(out)
            texts.append(hashes)
            size += len(hashes)
            if size > GROUP:
                yield row(ids, held, texts)
                number += 1
                ids, held, texts, size = [], [], [], 0
    if texts:
        yield row(ids, held, texts)


def _rows(batch: pa.RecordBatch, some: int) -> Iterator[dict]:
    """The rows of a batch, of which only some are Python objects at a time."""
    for at in range(0, batch.num_rows, some):
        yield from batch.slice(at, some).to_pylist()


def _group_pairs(known: np.ndarray, at: np.ndarray, owner: np.ndarray):
    """Tokens with a context in the same text, the distinct pairs by lane, each token's pair."""
    after = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    keys, which = np.unique(pair_keys(known[at[after - 1]], known[at[after]]),
                            return_inverse=True)
    return after, keys, which


def _open(words_data: bytes, at_data: bytes, sizes: list[int]):
    known, at = np.frombuffer(words_data, np.uint64), np.frombuffer(at_data, np.uint32)
    return known, at, np.repeat(np.arange(len(sizes)), sizes)


def _asked(lanes: int):
    """What each group asks each lane: its distinct words and pairs there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _rows(batch.select(["batch", "sizes", "words", "at"]), 1):
                known, at, owner = _open(r["words"], r["at"], r["sizes"])
                pairs = _group_pairs(known, at, owner)[1]
                for kind, keys, names in ((WORDS, known, known), (PAIRS, pairs, in_lane(pairs))):
                    found, begin, end = _by_lane(keys, lanes)
                    data = [names[i:j].tobytes() for i, j in zip(begin.tolist(), end.tolist())]
                    yield pa.RecordBatch.from_pydict({
                        "kind": pa.array([kind] * len(found), pa.int32()), "lane": pa.array(found),
                        "batch": pa.array([r["batch"]] * len(found), pa.int64()),
                        "data": pa.array(data, pa.binary())})

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by lane, the lane's own row first: it answers the questions after it, those
    of one Arrow batch together."""
    lane, store = None, None
    for batch in batches:
        rows = batch.to_pylist()
        keep, out, i = [], [], 0
        while i < len(rows):
            here = rows[i]["kind"], rows[i]["lane"]
            if rows[i]["batch"] < 0:
                lane, store = here, _store(here[0], rows[i]["data"])
                i += 1
                continue
            end = i
            while end < len(rows) and (rows[end]["kind"], rows[end]["lane"]) == here:
                end += 1
            asked = [r["data"] for r in rows[i:end]]
            of = np.uint64 if here[0] == WORDS else np.uint32
            found = _found(here[0], np.frombuffer(b"".join(asked), of),
                           store if lane == here else None)
            cuts = np.cumsum([len(a) // of().itemsize for a in asked])[:-1]
            out += [part.tobytes() for part in np.split(found, cuts)]
            keep += range(i, end)
            i = end
        if keep:
            answered = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_pydict({
                **{c: answered.column(c) for c in ("kind", "lane", "batch")},
                "data": pa.array(out, pa.binary())})


def _store(kind: int, data: bytes):
    if kind == PAIRS:
        return np.frombuffer(data, np.uint8)
    part = len(data) // 3
    return [np.frombuffer(data[i * part:(i + 1) * part], of)
            for i, of in enumerate((np.uint64, np.int64, np.float64))]


def _found(kind: int, keys: np.ndarray, store) -> np.ndarray:
    """Levels of pairs; counts and covered occurrences of words. Zeros from a lane without keys."""
    if kind == PAIRS:
        return (levels_of(keys.astype(np.uint64), store) if store is not None
                else np.zeros(len(keys))).astype(np.uint8)
    out = np.zeros((len(keys), 2))
    if store is not None:
        known, n, covered = store
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        hit = known[at] == keys
        out[hit, 0], out[hit, 1] = n[at[hit]], covered[at[hit]]
    return out


_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
           "score double")


def _score(total: int, distinct: int):
    """Rows come by group: its tokens, then the answers of the lanes in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, answers = None, None
        for batch in batches:
            for r in _rows(batch, ROWS):
                if r["kind"] == TOKENS:
                    if group:
                        yield done(group, answers)
                    group, answers = r, {WORDS: [], PAIRS: []}
                else:
                    answers[r["kind"]].append(r["data"])
        if group:
            yield done(group, answers)

    def done(group, answers) -> pa.RecordBatch:
        known, at, owner = _open(group["words"], group["at"], group["sizes"])
        after, _, which = _group_pairs(known, at, owner)
        n, covered = np.frombuffer(b"".join(answers[WORDS]), float).reshape(-1, 2).T
        levels = np.frombuffer(b"".join(answers[PAIRS]), np.uint8)
        seen, base, score = measure(at, after, levels[which].astype(np.int64), n, covered,
                                    total, distinct)
        docs = len(group["sizes"])
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(group["doc_ids"], pa.int64()),
            "held_out": pa.array(group["held"], pa.bool_()),
            "n_tokens": pa.array(group["sizes"], pa.int64()),
            "n_known": pa.array(np.bincount(owner, seen, docs).astype(np.int64)),
            "base_score": pa.array(np.bincount(owner, base, docs)),
            "score": pa.array(np.bincount(owner, score, docs))})

    return run


def measure(at: np.ndarray, after: np.ndarray, levels: np.ndarray, n: np.ndarray,
            covered: np.ndarray, total: int, distinct: int):
    """For each token: whether training knows it, its base score and its score."""
    size = total + 0.1 * (distinct + 1)
    logs = np.log10((n + 0.1) / size) if total else np.zeros(len(n))
    # quantised counts can add up to more than the context's own count
    scale = np.maximum(np.maximum(covered, n), 1)
    base = logs[at]
    h, w = at[after - 1], at[after]
    rest = np.zeros(len(at))
    rest[after] = np.log10(1 - SHARE * covered[h] / scale[h])
    gain = rest.copy()
    hit = (levels > 0) & (n[h] > 0) & (n[w] > 0)
    both, h = after[hit], h[hit]
    seen = np.minimum(count_of(levels[hit]), scale[h])
    p = SHARE * seen / scale[h] + 10 ** (rest[both] + base[both])
    gain[both] = np.log10(np.minimum(p, 1.0)) - base[both]
    return n[at] > 0, base, base + gain


def score(docs: DataFrame, model: dict, stored: DataFrame) -> DataFrame:
    """Scores of `docs` (doc_id, text, held_out), a row each."""
    size = _bytes(docs)
    groups = common.staged(docs.select("doc_id", "text", "held_out")
                           .mapInArrow(_grouped, _TOKENS), "tokens", ROWS)
    asked = stored.unionByName(groups.mapInArrow(_asked(model["lanes"]), _LANES))
    answers = common.staged(_dealt(asked, size, ["kind", "lane"], ["kind", "lane", "batch"])
                            .mapInArrow(_answers, _LANES), "answers", ASKED_ROWS)
    rows = _dealt(groups.withColumns({"kind": F.lit(TOKENS), "lane": F.lit(0)})
                  .unionByName(answers, allowMissingColumns=True),
                  size, ["batch"], ["batch", "kind", "lane"])
    scored = rows.mapInArrow(_score(model["total"], model["distinct"]), _SCORES)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(model["total"]).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        common.in_fold("doc_id", FOLDS).alias("held_out"))
    model, stored = train(docs.where("NOT held_out").select("text"))
    return score(docs, model, stored)
