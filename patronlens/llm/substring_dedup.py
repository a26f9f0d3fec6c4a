"""Substring dedup: repeated runs of words are found by doubling the length of windows.

Level by level (5, 10, 20 words, ...) windows are compared across all documents; only what
repeats at one length is looked at with twice the length, until the asked-for length is
reached or nothing repeats any more. Below the final length a repeated long window shows in
its smallest short window: two equal long windows hold the same short windows, so they also
share the one with the smallest hash. It is enough to compare these anchors, about one
position in eight, and no repeat is lost.

Every level is one grouped count over hashes (partially aggregated, so a passage of millions
of copies arrives as a row per task) and one semi join back (which adaptive execution splits
when a hash is hot). Documents meet their surviving anchors or windows by doc_id.

Defined cases: a null or empty text has no words and stays as it is; fewer words than a
window means nothing to remove; rows without doc_id are neither compared nor changed; rows
that repeat a doc_id count as one document listed several times; overlapping windows of one
document are compared like any others. Other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronlens.llm import common, words

_ANCHORS = "hash long, doc_id long"
_WINDOWS = "hash long, doc_id long, start int"


def levels(window: int, seed: int) -> list[int]:
    out = [min(seed, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def smallest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Value and position of the first smallest of every `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    best, where, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        later = right < left
        best = np.where(later, right, left)
        where = np.where(later, where[step:], where[:-step])
        have += step
    return best, where


def _anchors(hashes: np.ndarray, length: int, window: int):
    """Anchor value of each window, and for each distinct anchor position its value."""
    best, where = smallest(words.windows(hashes, length), window - length + 1)
    new = np.ones(len(where), bool)
    new[1:] = where[1:] != where[:-1]
    return best, best[new], new


def _emit(length: int, window: int, below: int | None):
    """A mapper that writes what one level compares, for windows that survived the level
    `below` (all of them on the first level)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            alive = batch.column("alive") if below else None
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            held = 0
            for i, hashes in enumerate(words.hashes_of(words.text_bytes(batch.column("text")))):
                if len(hashes) < window:
                    continue
                keep = None
                if below:
                    known = alive[i].values.to_numpy().view(np.uint64)
                    keep = np.isin(_anchors(hashes, below, window)[0], known)
                if length < window:
                    best, values, new = _anchors(hashes, length, window)
                    if keep is not None:  # an anchor counts if any of its windows survived
                        group = np.cumsum(new) - 1
                        values = values[np.bincount(group, keep, len(values)) > 0]
                    values, count = np.unique(values, return_counts=True)
                    values = np.concatenate((values, values[count > 1]))  # twice is enough
                    starts = np.zeros(0, np.int32)
                else:
                    values = words.windows(hashes, window)
                    starts = np.arange(len(values), dtype=np.int32)
                    if keep is not None:
                        values, starts = values[keep], starts[keep]
                    # a sequence further up in the same document needs no comparison
                    again = np.ones(len(values), bool)
                    again[np.unique(values, return_index=True)[1]] = False
                    values = np.ma.array(values, mask=again)
                found.append((values, np.full(len(values), ids[i], np.int64), starts))
                held += len(values)
                if held > 1_000_000:
                    yield _batch(found, length == window)
                    found, held = [], 0
            if found:
                yield _batch(found, length == window)

    return run


def _batch(found, final: bool) -> pa.RecordBatch:
    hashes = np.ma.concatenate([f[0] for f in found])
    columns = {"hash": pa.array(hashes.data.view(np.int64), mask=np.ma.getmaskarray(hashes)),
               "doc_id": pa.array(np.concatenate([f[1] for f in found]))}
    if final:
        columns["start"] = pa.array(np.concatenate([f[2] for f in found]))
    return pa.RecordBatch.from_pydict(columns)


def repeated_windows(docs: DataFrame, window: int = 20, seed: int = 5) -> DataFrame:
    """(doc_id, start) of every window whose words also start earlier, that is in a smaller
    doc_id or further up in the same document; `docs` has doc_id and text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    alive, below = None, None
    for length in levels(window, seed):
        source = texts if alive is None else texts.join(alive, "doc_id")
        final = length == window
        rows = common.staged(
            source.mapInArrow(_emit(length, window, below), _WINDOWS if final else _ANCHORS),
            f"windows-{length}")
        if alive is not None:
            common.unstage(alive)
        if final:
            break
        repeated = (rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("hash"))
        alive = common.staged(rows.join(repeated, "hash", "left_semi").groupBy("doc_id")
                              .agg(F.collect_set("hash").alias("alive")), f"alive-{length}")
        common.unstage(rows)
        below = length
    known = rows.where("hash IS NOT NULL")
    first = (known.groupBy("hash").agg(F.min("doc_id").alias("first_doc"),
                                       F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("hash", "first_doc"))
    later = known.join(first, "hash").where("doc_id > first_doc").select("doc_id", "start")
    return later.unionByName(rows.where("hash IS NULL").select("doc_id", "start"))


def _cut(window: int):
    """A mapper that adds the kept words and the counts to documents with their starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = words.text_bytes(batch.column("text"))
            starts = batch.column("__starts")
            kept, total, removed = [], [], []
            for text, begin in zip(texts, starts):
                parts = text.split()  # bytes: splits at the separators of this module only
                total.append(len(parts))
                gone = np.zeros(len(parts), bool)
                if begin.is_valid:
                    change = np.zeros(len(parts) + 1, np.int64)
                    at = np.unique(begin.values.to_numpy())
                    at = at[at + window <= len(parts)]
                    change[at] += 1
                    np.subtract.at(change, at + window, 1)
                    gone = np.cumsum(change)[:-1] > 0
                    parts = [parts[i] for i in np.flatnonzero(~gone)]
                removed.append(int(gone.sum()))
                kept.append(b" ".join(parts))
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__starts"}
            columns |= {"kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                        "n_words": pa.array(total, pa.int64()),
                        "n_removed": pa.array(removed, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def remove_repeats(docs: DataFrame, window: int = 20, seed: int = 5) -> DataFrame:
    """`docs` with kept_text (the words outside repeated windows, joined by one space),
    n_words and n_removed; input columns of these names are replaced."""
    docs = docs.drop("kept_text", "n_words", "n_removed")
    starts = common.staged(repeated_windows(docs, window, seed).groupBy("doc_id")
                           .agg(F.collect_list("start").alias("__starts")), "starts")
    both = docs.join(starts.withColumnRenamed("doc_id", "__id"),
                     F.col("doc_id").cast("long") == F.col("__id"), "left").drop("__id")
    return both.mapInArrow(_cut(window), common.extended(
        docs.schema, kept_text="string", n_words="long", n_removed="long"))


def without_repeats(docs: DataFrame, window: int = 20, seed: int = 5) -> DataFrame:
    """`docs` with repeated windows cut from the text; a text that loses nothing is unchanged.
    The columns stay as they are, also such as are named like this operator's counts."""
    own = docs.select("doc_id", "text", F.struct(*(c for c in docs.columns if c != "text")).alias("row"))
    kept = remove_repeats(own, window, seed)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return kept.select(*(text.alias("text") if name == "text" else F.col(f"row.`{name}`")
                         for name in docs.columns))


def op1_substring_dedup(spark, sf_dir):
    kept = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                               lambda x: x <> '') AS ws
    FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(len(ws) - 19)) AS i FROM w WHERE len(ws) >= 20),
runs AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 20], ' ') AS run FROM starts),
later AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS k FROM runs)
    WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS p FROM w)
SELECT w.doc_id, len(any_value(w.ws))::BIGINT AS n_words, count(gone.p)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(each.word, ' ' ORDER BY each.p)
                       FILTER (each.word IS NOT NULL AND gone.p IS NULL), '')) AS kept_sha256
FROM w LEFT JOIN each ON each.doc_id = w.doc_id
LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.p = each.p
GROUP BY w.doc_id
"""
