"""Best-fit packing: length patterns by non-negative least squares, the rest by best fit.

Texts become token ids, closed by an end id; only what is longer than a sequence is cut. The
histogram of piece lengths (at most one row per possible length) goes to the driver, which
plans how often each pattern of lengths is used:

1. patterns of one, two or three lengths that fill a sequence exactly are enumerated, evenly
   thinned where there would be more than `MAX_PATTERNS`;
2. repeat counts with patterns @ counts ~ histogram are fitted by non-negative least squares
   (accelerated projected gradient), rounded and held within what is left of each length;
3. the residual lengths are packed by best fit: the longest piece left, then again and again
   the longest that still fits, repeated as often as the histogram allows.

The plan depends on the histogram alone; its size follows the sequence length, not the data.
Pieces are numbered within their length (per task first, then by the tasks' totals, so that a
length that a third of all pieces share is not gathered anywhere) and look their place up in
the plan.

Defined cases: null and empty texts are the end id alone; equal rows are packed each; no rows
give no sequences; a null doc_id is kept as it is."""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from patronlens.llm import common, words

CAPACITY = 2048
END = 0
MAX_PATTERNS = 400_000
CACHED_WORDS = 300_000

_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, task int, "
           "rank long")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encoder(path: str):
    """Texts to little-endian ids. The tokenizer ignores case and white space, never joins what
    white space separates and parts letters from signs. So distinct lower-cased words are encoded
    once and looked up from then on: a word of Latin letters by the tokenizer's model alone,
    as the steps before it would not change it; others by the whole tokenizer. Words seen in one
    group of texts only make room when there are too many."""
    from tokenizers import Tokenizer, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    tokenizer = Tokenizer.from_file(path)
    split_by_model = tokenizer.model.tokenize
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    letters = {i: as_bytes.pre_tokenize_str(chr(i))[0][0] for i in range(0x250)
               if chr(i).isalpha() and chr(i).lower() == chr(i)
               and unicodedata.is_normalized("NFC", chr(i))}
    plain = set(map(chr, letters))
    known: dict[bytes, bytes] = {}
    once: set[bytes] = set()

    def learn(new: set[bytes]) -> None:
        others = []
        for word in new:
            core = word.rstrip(b".,")
            text = core.decode("utf-8")
            if not plain.issuperset(text) or (core != word and not core):
                others.append(word)
                continue
            ids = known.get(core)
            if ids is None:
                ids = array("I", [t.id for t in split_by_model(text.translate(letters))]).tobytes()
                known[core] = ids
                once.add(core)
            if core != word:
                stop = word[len(core):]
                if stop not in known:
                    whole([stop])
                known[word] = ids + known[stop]
        whole(others)

    def whole(some: list[bytes]) -> None:
        for i in range(0, len(some), 10_000):
            part = some[i:i + 10_000]
            for word, found in zip(part, tokenizer.encode_batch_fast(
                    [w.decode("utf-8") for w in part], add_special_tokens=False)):
                known[word] = array("I", found.ids).tobytes()

    def encode(texts: list[bytes]) -> list[bytes]:
        if len(texts) == 1 and len(texts[0]) > 2 * words.BLOCK_BYTES:
            return [b"".join(encode([texts[0][a:b]])[0] for a, b in words.slices(texts[0]))]
        split = [t.lower().split() for t in texts]
        distinct = set().union(*split)
        once.difference_update(distinct)
        new = distinct - known.keys()
        learn(new)
        once.update(new)
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        if len(known) > CACHED_WORDS:
            for word in once:
                known.pop(word, None)
            once.clear()
            if len(known) > CACHED_WORDS:
                known.clear()
        return out

    return encode


def _tokenize(path: str, capacity: int, kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # a broadcast value lives as long as the worker: each fills its own for all its tasks
        encode = kept.value.get(path)
        if encode is None:
            encode = kept.value[path] = _encoder(path)
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = words.text_bytes(batch.column("text"))
            rows: list[tuple] = []
            for first, group in _groups(texts):
                for i, tokens in enumerate(encode(group), first):
                    tokens = memoryview(tokens + END.to_bytes(4, "little"))
                    n = len(tokens) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        crc = zlib.crc32(tokens[4 * start:4 * (start + length)])
                        rows.append((ids[i], piece, start, length, crc, task, int(ranks[length])))
                        ranks[length] += 1
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                    pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])

    return run


def _groups(texts: list[bytes], size: int = 1 << 21) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in groups of about `size` bytes, each with the number of its first text."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, texts[first:i]
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, texts[first:]


# --- the plan ----------------------------------------------------------------------------

def full_patterns(histogram: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns (rows of three lengths, 0 for none) of present lengths that fill a sequence."""
    present = np.flatnonzero(histogram)
    rows = [np.array([[capacity, 0, 0]])] if histogram[capacity] else []
    half = present[(present <= capacity // 2)]
    mates = capacity - half
    pairs = half[histogram[mates] > 0]
    rows.append(np.stack([capacity - pairs, pairs, np.zeros_like(pairs)], axis=1))
    short = present[present < capacity]
    a, b = np.triu_indices(len(short))
    third = capacity - short[a] - short[b]
    good = (third >= short[b]) & (third > 0)
    a, b, third = a[good], b[good], third[good]
    good = histogram[third] > 0
    triples = np.stack([third[good], short[b[good]], short[a[good]]], axis=1)
    step = max(1, -(-len(triples) // MAX_PATTERNS))
    return np.concatenate([*rows, triples[::step]]).astype(np.int64)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Non-negative repeat counts whose lengths come closest to the histogram."""
    size = len(histogram)
    target = histogram.astype(float)
    flat = patterns.ravel()

    def lengths(x: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, np.repeat(x, patterns.shape[1]), size)
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns].sum(axis=1)

    # the step from the largest eigenvalue of A'A, by power iteration
    v = np.ones(len(patterns))
    norm = 1.0
    for _ in range(12):
        v = back(lengths(v))
        norm = float(np.linalg.norm(v))
        v /= norm
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        r = lengths(y) - target
        r[0] = 0
        after = np.maximum(0, y - back(r) / (1.05 * norm))
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Patterns with their repeat counts that use up the histogram exactly."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[list[int], int]] = []

    def use(pattern: list[int], times: int) -> None:
        for length in pattern:
            left[length] -= times
        out.append((pattern, times))

    patterns = full_patterns(left, capacity)
    if len(patterns):
        counts = fit_counts(patterns, left)
        carry: dict[int, float] = {}
        for k in np.argsort(-counts, kind="stable").tolist():
            if counts[k] <= 1e-6:
                break
            pattern = [n for n in patterns[k].tolist() if n]
            # what rounding leaves over goes to the next pattern with the same longest piece
            wanted = counts[k] + carry.get(pattern[0], 0.0)
            times = min(round(wanted), *(int(left[n]) // pattern.count(n) for n in pattern))
            carry[pattern[0]] = wanted - times
            if times > 0:
                use(pattern, times)
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return out
        pattern, room, taken = [], capacity, {}
        while True:
            fitting = present[:np.searchsorted(present, room, "right")]
            at = len(fitting) - 1
            while at >= 0 and left[fitting[at]] <= taken.get(int(fitting[at]), 0):
                at -= 1
            if at < 0:
                break
            length = int(fitting[at])
            pattern.append(length)
            taken[length] = taken.get(length, 0) + 1
            room -= length
        use(pattern, min(int(left[n]) // c for n, c in taken.items()))


def _slots(patterns: list[tuple[list[int], int]], capacity: int) -> dict[int, tuple]:
    """For each length, runs of places: first rank, first sequence and offset of each run."""
    found: dict[int, list[list[int]]] = {}
    sequence = 0
    used = np.zeros(capacity + 1, np.int64)
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            found.setdefault(length, []).append([int(used[length]), sequence, offset])
            used[length] += times
            offset += length
        sequence += times
    return {length: tuple(np.array(runs, np.int64).T) for length, runs in found.items()}


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence = np.zeros(len(lengths), np.int64)
            offset = np.zeros(len(lengths), np.int64)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                first, begin, place = slots[length]
                k = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at] = begin[k] + ranks[at] - first[k]
                offset[at] = place[k]
            columns = dict(zip(batch.schema.names, batch.columns))
            del columns["rank"]
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence),
                                                        "offset": pa.array(offset)})

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document with its sequence and the offset there."""
    tokenizer = tokenizer or tokenizer_path()
    spark = docs.sparkSession
    pieces = common.staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text"))
        .mapInArrow(_tokenize(tokenizer, capacity, spark.sparkContext.broadcast({})), _PIECES),
        "pieces")
    totals = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = totals.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    before = common.staged(before, "before")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in before.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row.length] = row.n
    slots = spark.sparkContext.broadcast(_slots(plan(histogram, capacity), capacity))
    ranked = (pieces.join(before.select("length", "task", "before"), ["length", "task"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("rank") + F.col("before")).alias("rank")))
    return ranked.mapInArrow(_place(slots), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, sequence_id long, offset long")


def op2_best_fit_packing(spark, sf_dir):
    return pack(common.table(spark, sf_dir, "documents"))
