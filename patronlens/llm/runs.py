"""Periodic run detection in grammar-compressed texts.

A run is a stretch of words with smallest period q that holds at least four periods and six
words and cannot be extended. Word numbers are compressed by Re-Pair: the most frequent pair
of neighbours becomes a nonterminal, again and again, ties going to the shortest expansion so
that the grammar stays shallow; what is left is joined pairwise. Every run lies inside the
expansion of some node and crosses the border of the node's two halves: the runs over that
border are computed once per nonterminal, at its first place in the text, and carried to all
places where it is derived. Intervals of one period that overlap by a period are merged, and
those inside a run of a smaller period that divides theirs are dropped.

At a border a run has two of its four periods on one side, so a period is sought as a square
that begins (or ends) there; after a square of period q reaching as far as r words no period
up to r / 2 can be new, which leaves a logarithmic number of comparisons per border.

Before compression a text is cut to the parts that may hold a run, in which every word occurs
at least four times and every pair of neighbours three times. This loses no run and leaves
ordinary prose empty.

A document is worked on by itself and whole; its cost is about n log n for n words. Defined
cases: null or empty text has no words, no run and an empty rest; rows without doc_id are
looked at as they are; repeated rows give repeated results; an empty table gives no rows; other
columns are ignored."""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronlens.llm import common, words

# What counts as a run.
PERIODS, WORDS = 4, 6


def stretches(ids: np.ndarray, rare: int) -> list[tuple[int, int]]:
    """Begin and end of the parts of `ids` that may hold a run; `rare` and above are numbers of
    words with fewer than PERIODS occurrences."""
    at = np.flatnonzero(ids < rare)
    joined = np.diff(at) == 1  # this word and the next one are in one part
    while len(at) >= WORDS:
        part = np.concatenate(([0], np.cumsum(~joined)))
        keep = (np.bincount(part) >= WORDS)[part]
        _, key, count = np.unique(part * rare + ids[at], return_inverse=True, return_counts=True)
        keep &= (count >= PERIODS)[key]
        _, pair, count = np.unique(key[:-1] * rare + ids[at[1:]], return_inverse=True,
                                   return_counts=True)
        linked = joined & (count >= PERIODS - 1)[pair]
        if keep.all() and (linked == joined).all():
            edge = np.flatnonzero(np.concatenate(([True], ~joined, [True])))
            return list(zip(at[edge[:-1]].tolist(), (at[edge[1:] - 1] + 1).tolist()))
        kept = np.flatnonzero(keep)
        at = at[kept]
        joined = (np.diff(kept) == 1) & linked[kept[:-1]]
    return []


class Grammar:
    """A straight-line grammar of one stretch. Node k has the halves left[k], right[k] (None
    for words), length[k] words, and first[k], its first place in the text."""

    def __init__(self, text: Sequence[int]) -> None:
        n = len(text)
        number: dict[int, int] = {}
        self.left: list[int | None] = []
        self.right: list[int | None] = []
        self.length: list[int] = []
        self.first: list[int] = []
        seq = []
        for i, word in enumerate(text):
            k = number.get(word)
            if k is None:
                k = number[word] = self._node(None, None, 1, i)
            seq.append(k)
        self._replace(seq, n)

    def _node(self, left, right, length: int, first: int) -> int:
        self.left.append(left)
        self.right.append(right)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _replace(self, seq: list[int], n: int) -> None:
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        places: dict[tuple[int, int], list[int]] = {}
        for i in range(n - 1):
            places.setdefault((seq[i], seq[i + 1]), []).append(i)
        length = self.length
        order = 0
        heap = []
        for pair, at in places.items():
            if len(at) > 1:
                heap.append((-len(at), 2, order, pair))
                order += 1
        heapq.heapify(heap)
        while heap:
            count, _, _, pair = heapq.heappop(heap)
            at = places.get(pair)
            if at is None:
                continue
            a, b = pair
            live = [i for i in at if seq[i] == a and after[i] < n and seq[after[i]] == b]
            if len(live) < -count:  # others have taken some of its places
                if len(live) > 1:
                    places[pair] = live
                    heapq.heappush(heap, (-len(live), length[a] + length[b], order, pair))
                    order += 1
                else:
                    del places[pair]
                continue
            del places[pair]
            live.sort()
            new, touched = None, {}
            for i in live:
                j = after[i]
                if seq[i] != a or j >= n or seq[j] != b:  # overlapped the one before
                    continue
                if new is None:
                    new = self._node(a, b, length[a] + length[b], i)
                seq[i], seq[j] = new, -1
                k = after[i] = after[j]
                if k < n:
                    before[k] = i
                    touched.setdefault((new, seq[k]), []).append(i)
                h = before[i]
                if h >= 0:
                    touched.setdefault((seq[h], new), []).append(h)
            for found, where in touched.items():  # pairs of a new symbol are new as well
                if len(where) > 1:
                    places[found] = where
                    heapq.heappush(heap, (-len(where), length[found[0]] + length[found[1]],
                                          order, found))
                    order += 1
        top, i = [], 0
        while i < n:
            top.append((seq[i], i))
            i = after[i]
        while len(top) > 1:  # what is left is joined pairwise
            joined = [(self._node(x[0], y[0], length[x[0]] + length[y[0]], x[1]), x[1])
                      for x, y in zip(top[0::2], top[1::2])]
            if len(top) % 2:
                joined.append(top[-1])
            top = joined
        self.root = top[0][0]


def _agree(text: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words from i and from j are equal, at most `most`."""
    done, step = 0, 16
    while done < most:
        step = min(step, most - done)
        same = text[i + done:i + done + step] == text[j + done:j + done + step]
        if not same.all():
            return done + int(np.argmin(same))
        done += step
        step *= 4
    return done


def _agree_back(text: np.ndarray, i: int, j: int, most: int) -> int:
    """How many words that end before i and before j are equal, at most `most`."""
    done, step = 0, 16
    while done < most:
        step = min(step, most - done)
        same = (text[i - done - step:i - done] == text[j - done - step:j - done])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += step
        step *= 4
    return done


def over_border(text: np.ndarray, following: Sequence[int], preceding: Sequence[int],
                begin: int, middle: int, end: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the repetitions of text[begin:end] that hold the words on both
    sides of `middle` and are long enough; `following` and `preceding` have the next and the
    last place of the same word."""
    found = set()

    def add(left: int, right: int, q: int) -> None:
        if right - left >= max(WORDS, PERIODS * q) and left < middle < right:
            found.add((left, right, q))

    most = (end - middle) // 2  # two periods to the right
    known, at = 0, following[middle]
    while at - middle <= most:
        q = at - middle
        if 2 * q > known and _agree(text, middle, at, q) == q:
            right = at + _agree(text, middle, at, end - at)
            add(middle - _agree_back(text, middle, at, middle - begin), right, q)
            known = right - middle
        at = following[at]
    most = (middle - begin) // 2  # two periods to the left
    known, at = 0, preceding[middle - 1]
    while middle - 1 - at <= most and at >= 0:
        q = middle - 1 - at
        if 2 * q > known and _agree_back(text, middle, middle - q, q) == q:
            left = middle - q - _agree_back(text, middle - q, middle, middle - q - begin)
            add(left, middle + _agree(text, middle - q, middle, end - middle), q)
            known = middle - left
        at = preceding[at]
    return list(found)


def grammar_runs(text: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of one stretch, by its grammar."""
    values = text.tolist()
    n = len(values)
    following, preceding = [n + n] * n, [-1] * n
    last: dict[int, int] = {}
    for i, word in enumerate(values):
        j = last.get(word)
        if j is not None:
            following[j], preceding[i] = i, j
        last[word] = i
    g = Grammar(values)
    left, right, length, first = g.left, g.right, g.length, g.first
    own: list[list[tuple[int, int, int]] | None] = []
    inside = []  # whether the node or one below has a repetition
    for k in range(len(length)):
        if left[k] is None or length[k] < WORDS:
            own.append(None)
            inside.append(False)
            continue
        begin = first[k]
        middle, end = begin + length[left[k]], begin + length[k]
        near = (following[middle] - middle <= (end - middle) // 2
                or middle - 1 - preceding[middle - 1] <= (middle - begin) // 2)
        mine = over_border(text, following, preceding, begin, middle, end) if near else []
        own.append([(s - begin, e - begin, q) for s, e, q in mine])
        inside.append(bool(mine) or inside[left[k]] or inside[right[k]])
    found: dict[int, set[tuple[int, int]]] = {}
    stack = [(g.root, 0)]
    while stack:  # all places of the nodes that have something
        k, at = stack.pop()
        if not inside[k]:
            continue
        for s, e, q in own[k]:
            found.setdefault(q, set()).add((at + s, at + e))
        stack.append((left[k], at))
        stack.append((right[k], at + length[left[k]]))
    return _maximal(found)


def _maximal(found: dict[int, set[tuple[int, int]]]) -> list[tuple[int, int, int]]:
    """Merges intervals of one period that share a period; drops multiples of a period."""
    out: list[tuple[int, int, int]] = []
    for q in sorted(found):
        merged: list[list[int]] = []
        for s, e in sorted(found[q]):
            if merged and s <= merged[-1][1] - q:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        smaller = [r for r in out if q % r[2] == 0]
        out += [(s, e, q) for s, e in merged
                if not any(a <= s and e <= b for a, b, _ in smaller)]
    return out


def runs_of(parts: Sequence[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, by start, then period."""
    counts = Counter(parts)
    often = [w for w, c in counts.items() if c >= PERIODS]
    if not often or sum(counts[w] for w in often) < WORDS:
        return []
    number = dict(zip(often, range(len(often))))
    rare = len(often)
    ids = np.array([number.get(w, rare) for w in parts], np.int64)
    out = []
    for begin, end in stretches(ids, rare):
        out += [(begin + s, e - s, q) for s, e, q in grammar_runs(ids[begin:end])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(parts: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, for one in ten ids with an end that repeats."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(parts), h // 10
    if h % 10 or not n:
        return parts
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return parts[:a] + parts[a:a + p] * whole + parts[a:a + rest]


def collapsed(parts: list[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return parts
    change = np.zeros(len(parts) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return [parts[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


FOUND = {"n_runs": "long", "start": "long", "length": "long", "period": "long",
         "exponent_milli": "long", "runs_sha256": "string", "collapsed_sha256": "string"}
_ARROW = {"long": pa.int64(), "string": pa.string()}


def _figures(parts: list[bytes]) -> tuple:
    runs = runs_of(parts)
    best = None
    for start, length, q in runs:  # by start, then period: the first of equal ones stays
        if best is None or length * best[2] > best[1] * q:
            best = (start, length, q)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    rest = b" ".join(collapsed(parts, runs))
    return (len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def _measure(loop: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc_id, text in zip(ids, words.text_bytes(batch.column("text"))):
                parts = text.split()  # bytes: splits at the separators of this module only
                rows.append(_figures(looped(parts, doc_id) if loop else parts))
            found = list(zip(*rows)) or [()] * len(FOUND)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(v, _ARROW[k])
                                            for v, k in zip(found, FOUND.values())],
                names=["doc_id", *FOUND])

    return run


def periodic_runs(docs: DataFrame, loop: bool = False) -> DataFrame:
    """Per document: n_runs, the run with the greatest exponent (start, length, period,
    exponent_milli), digests of all runs and of the words left when each run keeps its first
    period. `loop` first makes the end of one document in ten repeat."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ddl = "doc_id long, " + ", ".join(f"{n} {k}" for n, k in FOUND.items())
    return texts.mapInArrow(_measure(loop), ddl)


def runs_table(docs: DataFrame) -> DataFrame:
    """A row for every run: doc_id, start, length, period in words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    words.text_bytes(batch.column("text"))):
                for found in runs_of(text.split()):
                    for column, value in zip(out, (doc_id, *found)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             names=["doc_id", "start", "length", "period"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, start long, length long, period long")


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs(common.table(spark, sf_dir, "documents"), loop=True)
