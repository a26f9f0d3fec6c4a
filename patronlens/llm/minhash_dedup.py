"""MinHash near-dedup with b-bit signatures.

A document is the set of its distinct runs of five lower-cased words. Documents with equal
sets form a class; the smallest doc_id stands for it, so copies never meet in pairs. For each
class 240 minima are taken: 48 bands of 5 give candidate groups (a pair at similarity 0.75
misses all bands with a probability of 2e-6), and the two low bits of every minimum, packed
into eight longs, give an estimate by bit counts, corrected for the quarter of minima that
agree by chance. Pairs whose estimate is above the threshold less four standard errors are
confirmed on their full sets, and so is every candidate pair in which one set has fewer than
`FEW` shingles and the sizes allow the threshold: for small sets the chance agreement varies.

Groups are not expanded into pairs. Members of a band group are first compared with the
group's centre: each document with the one it shares most bands with, then with the others
it is not yet connected to; at last, inside groups that still hold several components, pairs across
components, which the estimate and the sets' smallest 512 hashes thin out within the join, for
sets of that size exactly. A pair that is skipped joins documents
that are connected already, so components are the same as with all pairs. Components come
from smallest labels with pointer jumping, as joins.

Defined cases: null text, no text or no words: an empty set, linked with nothing; fewer than
five words: the whole sequence is the one shingle; rows without doc_id have no component and
are kept; rows that repeat a doc_id are the same document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronlens.llm import common, words

SHINGLE = 5
THRESHOLD = 75  # percent
BANDS, ROWS = 48, 5
BITS = 2
PLANES = BITS * 4  # longs of a signature
SLACK = 0.135  # of the estimate, four standard errors of 240 minima
SKETCH, SKETCH_SLACK = 512, 0.077  # smallest hashes of a set; four standard errors of them
FEW = 64  # with fewer shingles a pair is confirmed whatever its estimate

_PLANES = ", ".join(f"s{i} long" for i in range(PLANES))
_SCHEMA = f"doc_id long, n long, d1 long, d2 long, bands array<long>, {_PLANES}"


def shingles(hashes: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    if not len(hashes):
        return hashes
    return np.unique(words.windows(hashes, min(length, len(hashes))))


def minima(values: np.ndarray, count: int) -> np.ndarray:
    """`count` minima of a set of evenly spread hashes, 32 bits each."""
    factor = (words.multipliers(count, 7) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    shift = (words.multipliers(count, 11) >> np.uint64(32)).astype(np.uint32)
    best = np.full(count, 0xFFFFFFFF, np.uint32)
    low = (values >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), 512):
        np.minimum(best, (low[i:i + 512, None] * factor + shift).min(axis=0), out=best)
    return best


def _packed(best: np.ndarray) -> np.ndarray:
    """BITS planes of 256 bits: plane i holds bit i of every minimum, mixed first, as the low
    bits of a minimum follow from the low bits of its shingle alone."""
    mixed = words.mix(best.astype(np.uint64) + words.multipliers(len(best), 13))
    planes = np.zeros((BITS, 256), np.uint8)
    for i in range(BITS):
        planes[i, :len(best)] = (mixed >> np.uint64(i)) & np.uint64(1)
    return np.packbits(planes, axis=1).view(np.int64).ravel()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = words.multipliers(ROWS, 3)
    for batch in batches:
        texts = (words.lower_ascii(t) for t in words.text_bytes(batch.column("text")))
        sizes, digests, bands, packed = [], [], [], []
        for hashes in words.hashes_of(texts):
            found = shingles(hashes)
            sizes.append(len(found))
            if not len(found):
                digests.append((None, None))
                bands.append(np.zeros(0, np.int64))
                packed.append(np.zeros(PLANES, np.int64))
                continue
            digests.append(tuple(int(words.mix(found ^ np.uint64(c)).sum().view(np.int64))
                                 for c in (0, 0x5851F42D4C957F2D)))
            best = minima(found, BANDS * ROWS)
            keys = (best.reshape(BANDS, ROWS).astype(np.uint64) * weights).sum(axis=1)
            bands.append(words.mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64)
                                   * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
            packed.append(_packed(best))
        offsets = np.cumsum([0, *map(len, bands)]).astype(np.int32)
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        planes = np.array(packed, np.int64).reshape(-1, PLANES)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()),
            "d1": pa.array([d[0] for d in digests], pa.int64()),
            "d2": pa.array([d[1] for d in digests], pa.int64()),
            "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            **{f"s{i}": pa.array(planes[:, i].copy()) for i in range(PLANES)}})


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest hashes of each set, shifted to be positive and in order."""
    for batch in batches:
        texts = (words.lower_ascii(t) for t in words.text_bytes(batch.column("text")))
        found = [(shingles(h)[:SKETCH] >> np.uint64(1)).view(np.int64)
                 for h in words.hashes_of(texts)]
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            "sketch": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [words.lower_ascii(t) for t in words.text_bytes(batch.column("text"))]
        ids = batch.column("doc_id")
        found, held, first = [], 0, 0
        for i, hashes in enumerate(words.hashes_of(texts)):
            found.append(shingles(hashes).view(np.int64))
            held += len(found[-1])
            if held > 500_000 or i == len(texts) - 1:
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids[first:i + 1],
                    "set": pa.ListArray.from_arrays(pa.array(offsets),
                                                    pa.array(np.concatenate(found)))})
                found, held, first = [], 0, i + 1


def _estimate(a: str, b: str):
    """Similarity from packed signatures, corrected for agreement by chance."""
    total = BANDS * ROWS
    differing = sum((F.bit_count(
        sum_or([F.col(f"{a}.s{p * 4 + i}").bitwiseXOR(F.col(f"{b}.s{p * 4 + i}"))
                for p in range(BITS)])) for i in range(4)), F.lit(0))
    chance = 1 / 2 ** BITS
    return (1 - differing / total - chance) / (1 - chance)


def _passes(a: str, b: str, estimate):
    """Pairs to confirm: those whose sizes allow the threshold, if they are likely or have few
    shingles."""
    x, y = F.col(f"{a}.n"), F.col(f"{b}.n")
    allowed = F.least(x, y) * 100 >= F.greatest(x, y) * THRESHOLD
    return allowed & ((F.least(x, y) < FEW) | (estimate >= THRESHOLD / 100 - SLACK))


def _near(a: str, b: str):
    """Whether two sketches allow a link. Sets of at most SKETCH shingles are whole in them,
    and the test is exact; for larger ones the SKETCH smallest hashes of both sets together are
    a sample of their union, and four standard errors are given away."""
    x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    shared = F.size(F.array_intersect(x, y))
    exact = shared * 100 >= (F.size(x) + F.size(y) - shared) * THRESHOLD
    union = F.slice(F.array_sort(F.array_union(x, y)), 1, SKETCH)
    common_part = F.size(F.array_intersect(union, F.array_intersect(x, y)))
    sampled = common_part >= F.size(union) * (THRESHOLD / 100 - SKETCH_SLACK)
    whole = (F.col(f"{a}.n") <= SKETCH) & (F.col(f"{b}.n") <= SKETCH)
    return F.when(whole, exact).otherwise(sampled)


def sum_or(columns):
    out = columns[0]
    for column in columns[1:]:
        out = out.bitwiseOR(column)
    return out


def _likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    planes = [f"s{i}" for i in range(PLANES)]
    left = signatures.select(F.col("doc_id").alias("a"), "n", *planes).alias("l")
    right = signatures.select(F.col("doc_id").alias("b"), "n", *planes).alias("r")
    return (pairs.join(left, "a").join(right, "b")
            .where(_passes("l", "r", _estimate("l", "r")))
            .select("a", "b", _estimate("l", "r").alias("likeness")))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold. The sets are made once, by the same plan
    at every size: the ids of the pairs are not broadcast."""
    ids = (pairs.select(F.col("a").alias("doc_id")).unionByName(
        pairs.select(F.col("b").alias("doc_id"))).distinct())
    sets = common.staged(texts.join(ids.hint("merge"), "doc_id", "left_semi")
                         .dropDuplicates(["doc_id"])
                         .mapInArrow(_sets, "doc_id long, set array<long>"), "sets")
    left = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    links = common.staged(
        pairs.select("a", "b").join(right, "b").join(left, "a")
        .select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("both"))
        .where(F.col("shared") * 100 >= (F.col("both") - F.col("shared")) * THRESHOLD)
        .select("a", "b"), "links")
    common.unstage(sets)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, component) for every end of an edge (a, b): the smallest doc_id reachable."""
    both = common.staged(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = common.staged(both.groupBy(F.col("a").alias("doc_id")).agg(
        F.least(F.min("b"), F.col("doc_id")).alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("doc_id", "b"), "b")
                .groupBy(F.col("a").alias("doc_id")).agg(F.min("component").alias("near")))
        lower = labels.join(near, "doc_id").select(
            "doc_id", F.col("component").alias("was"),
            F.least("component", "near").alias("now"))
        jumped = lower.join(labels.select(F.col("doc_id").alias("now"),
                                          F.col("component").alias("root")), "now", "left")
        after = common.staged(jumped.select(
            "doc_id", "was", F.least("now", F.coalesce("root", "now")).alias("component")),
            "labels")
        common.unstage(labels)
        labels = after
        if labels.where("was <> component").isEmpty():
            return labels.select("doc_id", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = "doc_id IS NOT NULL AND n > 0"
    every = common.staged(texts.mapInArrow(_signatures, _SCHEMA), "signatures")
    classes = common.staged(every.where(known).groupBy("d1", "d2").agg(
        F.min("doc_id").alias("leader")), "classes")
    leaders = common.staged(
        every.where(known).join(classes.withColumnRenamed("leader", "doc_id"),
                                ["d1", "d2", "doc_id"], "left_semi")
        .dropDuplicates(["doc_id"]).drop("d1", "d2"), "leaders")
    bands = leaders.select(F.explode("bands").alias("key"), "doc_id")
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = common.staged(bands.join(sizes, "key"), "shared")
    # a group's centre is the member that meets most others over all its groups: an original
    # rather than one of its altered copies
    weights = shared.groupBy("doc_id").agg(F.sum("size").alias("weight"))
    centres = (shared.select("key", "doc_id").join(weights, "doc_id").groupBy("key")
               .agg(F.max_by("doc_id", "weight").alias("a")))
    grouped = common.staged(shared.select("key", "doc_id").join(centres, "key"), "bands")
    common.unstage(shared)
    stars = common.staged(
        grouped.where("doc_id <> a").groupBy("a", F.col("doc_id").alias("b"))
        .agg(F.count(F.lit(1)).alias("bands")), "stars")
    # the star that shares most bands with a document first; it settles nearly all of them
    best = common.staged(stars.groupBy("b").agg(F.max_by("a", "bands").alias("a"))
                         .select("a", "b"), "best")
    edges = _confirmed(common.staged(_likely(best, leaders), "pairs"), texts)
    found = components(edges)
    rest = _across(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), found)
    for pairs in (lambda: _likely(rest, leaders), lambda: _inside(grouped, found, leaders, texts)):
        more = common.staged(pairs(), "pairs")
        # for each document the likeliest partner first, then what is still not connected
        first = more.groupBy("b").agg(F.max_by("a", "likeness").alias("a")).select("a", "b").union(
            more.groupBy("a").agg(F.max_by("b", "likeness").alias("b"))).distinct()
        for part in (lambda: first, lambda: _across(more, found)):
            chosen = common.staged(part(), "chosen")
            if not chosen.isEmpty():
                edges = common.staged(edges.unionByName(_confirmed(chosen, texts)), "links")
                found = components(edges)
    member = (every.select("doc_id", "n", "d1", "d2")
              .join(classes, ["d1", "d2"], "left")
              .join(found.withColumnRenamed("doc_id", "leader"), "leader", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "leader", "doc_id"))
    return member.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    left = found.select(F.col("doc_id").alias("a"), F.col("component").alias("ca"))
    right = found.select(F.col("doc_id").alias("b"), F.col("component").alias("cb"))
    return (pairs.join(left, "a", "left").join(right, "b", "left")
            .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))


def _inside(grouped: DataFrame, found: DataFrame, leaders: DataFrame,
            texts: DataFrame) -> DataFrame:
    """Likely pairs across components inside band groups, other than the groups' stars. The
    join carries sketches of the sets, so that pairs without a link do not leave it."""
    rows = grouped.join(found, "doc_id", "left").select(
        "key", "a", "doc_id", F.coalesce("component", "doc_id").alias("c"))
    mixed = (rows.where("doc_id <> a").groupBy("key")
             .agg(F.min("c").alias("low"), F.max("c").alias("high"))
             .where("low < high").select("key"))
    planes = [f"s{i}" for i in range(PLANES)]
    inner = common.staged(rows.where("doc_id <> a").join(mixed, "key").drop("a"), "mixed-groups")
    ids = inner.select("doc_id").distinct()
    sketches = common.staged(
        texts.join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        .mapInArrow(_sketches, "doc_id long, sketch array<long>"), "sketches")
    members = common.staged(inner.join(
        leaders.select("doc_id", "n", *planes).join(sketches, "doc_id"), "doc_id"), "mixed")
    common.unstage(inner, sketches)
    x, y = members.alias("x"), members.alias("y")
    likely = _passes("x", "y", _estimate("x", "y")) & _near("x", "y")
    return common.staged(
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.doc_id") < F.col("y.doc_id"))
               & (F.col("x.c") != F.col("y.c")) & likely)
        .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"),
                _estimate("x", "y").alias("likeness")).distinct(), "inner")


def one_of_each(docs: DataFrame) -> DataFrame:
    """`docs` without those that have an earlier near-duplicate; all columns as they are."""
    gone = (near_duplicates(docs.select("doc_id", "text")).where("NOT kept")
            .select(F.col("doc_id").alias("__gone")).distinct())
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__gone"], "left_anti")


def op7_minhash_dedup(spark, sf_dir):
    return near_duplicates(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(len(ws) - 4),
                           lambda i: array_to_string(ws[i + 1:i + 5], ' '))) END AS s
    FROM w),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM each a JOIN each b ON a.x = b.x AND a.doc_id < b.doc_id
    GROUP BY ALL
    HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
links AS (SELECT a, b FROM shared UNION ALL SELECT b, a FROM shared),
reach(a, b) AS (SELECT doc_id, doc_id FROM w
                UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.b)::BIGINT AS component_id,
       s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s
"""
