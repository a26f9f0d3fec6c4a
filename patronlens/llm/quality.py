"""Quality classifier: perplexity under a Kneser-Ney model of trusted text.

Documents labelled as good train an interpolated modified Kneser-Ney model over characters
(four at a time; white space runs count as one space, capitals stay apart). n-gram counts,
continuation counts, context totals and discounts are DataFrames, and the interpolated
probabilities come from joins of these counts, sharded by their context. A document's
perplexity is the inverse geometric mean of its characters' probabilities. Its fresh perplexity
is that of a reader who remembers: an n-gram met before in the same `WINDOW` characters costs
nothing. A document is rejected when its perplexity lies above, or its fresh perplexity below, a
threshold of its language, each beyond what chance explains in a text of its length: upper
quartile plus, lower quartile less, `FENCE` interquartile ranges of the trusted documents' logs.
So noise fails by the first and words repeated over and over by the second.

The model learns from all trusted documents, and the thresholds are exact quartiles of all of
them. The `SYMBOLS` most frequent trusted characters are told apart, more than any script has;
characters beyond them count as one. Looking every n-gram of every document up through a
shuffle would move each of them over the network, so documents meet the tables in memory while
these have at most `HELD` n-grams. Of larger ones the most frequent n-grams are held, and what
a document has beyond these is looked up by joins: same results, a bounded broadcast.

Defined cases: null or empty text (also white space alone): perplexity null, not kept; rows
without lang, or with a language without trusted documents, use the threshold over all
languages; no trusted document at all: no thresholds, everything with text is kept; a document
labelled several times counts as trusted if its smallest label is 1; repeated rows get equal
results; rows without doc_id are never trusted."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from patronlens.llm import common, words

ORDER = 4
HELD = 1 << 20  # n-grams of the highest order that are broadcast
BITS = 15  # of a symbol; four fit a long
SYMBOLS = (1 << BITS) - 4
FENCE = 3.0
CHANCE = 2.0  # standard errors
BINS = 4096  # of thresholds, in a step of one
WINDOW = 256
BLOCK = 1 << 19
START, END, OTHER, SPACE = 0, 1, 2, 3  # the first symbols


# --- texts to n-gram keys: BITS for each symbol ---------------------------------------------

def symbol_table(characters: list[int]) -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint16)
    table[characters] = np.arange(SPACE + 1, SPACE + 1 + len(characters), dtype=np.uint16)
    table[[ord(c) for c in (" ", "\t", "\n", "\v", "\f", "\r")]] = SPACE
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text without outer and repeated spaces, closed by an end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = table[points]
    space = found == SPACE
    again = space.copy()
    again[1:] &= space[:-1]
    found = found[~again]
    if len(found) and found[0] == SPACE:
        found = found[1:]
    if len(found) and found[-1] == SPACE:
        found = found[:-1]
    return np.append(found, np.uint16(END)) if len(found) else found


def keys(found: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each symbol."""
    padded = np.concatenate((np.full(order - 1, START, np.uint16), found)).astype(np.int64)
    out = np.zeros(len(found), np.int64)
    for i in range(order):
        out = (out << BITS) | padded[i:i + len(found)]
    return out


# --- training -----------------------------------------------------------------------------

def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total = np.zeros(0x110000, np.int64)
        for text in batch.column("text").to_pylist():
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            at, n = np.unique(points, return_counts=True)
            total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"point": pa.array(at.astype(np.int32)),
                                          "n": pa.array(total[at])})


def _count(table: np.ndarray, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                held.append(keys(symbols(text, table), order))
                size += len(held[-1])
                if size > 2_000_000 or i == len(texts) - 1:
                    at, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.RecordBatch.from_pydict({"gram": pa.array(at), "n": pa.array(n)})
                    held, size = [], 0

    return run


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    """The three discounts from how many n-grams were seen once, twice, ... (with the usual
    values where a small corpus has none of a kind)."""
    n = {r.n: r.k for r in counts.where("n <= 4").groupBy("n").agg(
        F.count(F.lit(1)).alias("k")).collect()}
    n1, n2, n3, n4 = (float(n.get(i, 0)) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, (3 - 4 * y * n4 / n3) if n3 else 1.5
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def fit(trusted: DataFrame, order: int = ORDER, held: int = HELD) -> dict | None:
    """Interpolated log probabilities for each order; `trusted` has a column text. "orders" are
    tables in memory: all of them, or beyond `held` n-grams the most frequent ones of the
    highest order, and then "rest" has DataFrames of everything."""
    texts = common.staged(trusted.select("text"), "trusted")
    known = (texts.mapInArrow(_characters, "point int, n long").groupBy("point")
             .agg(F.sum("n").alias("n")).where("point NOT IN (9, 10, 11, 12, 13, 32)")
             .orderBy(F.desc("n"), "point").limit(SYMBOLS).collect())
    if not known:
        common.unstage(texts)
        return None
    table = symbol_table([r.point for r in known])
    counts = common.staged(texts.mapInArrow(_count(table, order), "gram long, n long")
                           .groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    common.unstage(texts)
    by_order = {order: counts}
    for k in range(order - 1, 0, -1):  # lower orders count different left neighbours
        by_order[k] = common.staged(
            by_order[k + 1].groupBy((F.col("gram") % (1 << BITS * k)).alias("gram"))
            .agg(F.count(F.lit(1)).alias("n")), "grams")
    found: dict[int, DataFrame] = {}
    for k in range(1, order + 1):
        d1, d2, d3 = _discounts(by_order[k])
        grams = by_order[k].withColumn("context", F.shiftright("gram", BITS))
        totals = grams.groupBy("context").agg(
            F.sum("n").alias("total"),
            (F.sum(F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3))
             ).alias("kept_back")).withColumn("weight", F.col("kept_back") / F.col("total"))
        cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        joined = grams.join(totals, "context").withColumn(
            "own", F.greatest((F.col("n") - cut) / F.col("total"), F.lit(0.0)))
        if k == 1:
            prob = F.col("own") + F.col("weight") / (len(known) + SPACE + 1)
        else:
            joined = joined.join(found[k - 1].select(F.col("gram").alias("tail"),
                                                     F.col("p").alias("below")),
                                 F.col("gram") % (1 << BITS * (k - 1)) == F.col("tail"))
            prob = F.col("own") + F.col("weight") * F.col("below")
        found[k] = common.staged(
            joined.select("gram", "n", "context", "weight", prob.alias("p")), "kn")
    floor = float(np.log(found[1].first()["weight"]) - np.log(len(known) + SPACE + 1))
    model = {"table": table, "order": order, "floor": floor}
    if counts.count() <= held:  # no lower order has more
        model["orders"] = {k: _logs(found[k].select("gram", "p"))
                           + _logs(found[k].select("context", "weight").distinct()) for k in found}
        common.unstage(*found.values())
    else:
        model["orders"] = {order: _logs(_most_frequent(found[order], held).select("gram", "p"))}
        model["rest"] = found
    common.unstage(*by_order.values())
    return model


def _logs(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a bounded table in order and logs of its second column."""
    key, value = table.columns
    found = common.fetched(table.orderBy(key))
    return found[key].to_numpy(np.int64), np.log(found[value].to_numpy(np.float64))


def _most_frequent(grams: DataFrame, held: int) -> DataFrame:
    """The n-grams seen most often, at most `held`, cut between steps of the count."""
    step = F.floor(F.log2("n") * 64)
    sizes = common.fetched(grams.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k"))
                           .orderBy(F.desc("step")))
    fitting = sizes["step"][sizes["k"].cumsum() <= held]
    return grams.where(step >= int(fitting.iloc[-1])) if len(fitting) else grams.where("false")


def _place(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted keys have the wanted ones, and whether they do."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(known, wanted)
    at[at == len(known)] = 0
    return at, known[at] == wanted


def log_probabilities(grams: np.ndarray, model: dict, order: int | None = None) -> np.ndarray:
    """log p of the last symbol of each n-gram: its own entry, else the weight its context
    leaves to shorter ones (all of it for an unknown context) times the shorter n-gram's."""
    order = order or model["order"]
    known, logs, contexts, weights = model["orders"][order]
    at, hit = _place(known, grams)
    out = np.where(hit, logs[at], 0.0)
    miss = np.flatnonzero(~hit)
    if len(miss):
        if order == 1:
            out[miss] = model["floor"]
            return out
        rest = log_probabilities(grams[miss] % (1 << BITS * (order - 1)), model, order - 1)
        c, seen = _place(contexts, grams[miss] >> BITS)
        out[miss] = rest + np.where(seen, weights[c], 0.0)
    return out


def looked_up(grams: DataFrame, model: dict) -> DataFrame:
    """`grams` (gram, each once) with log_p, which is log_probabilities by joins."""
    left, done = grams.select("gram", F.col("gram").alias("short"), F.lit(0.0).alias("log_p")), []
    for k in range(model["order"], 0, -1):
        table = model["rest"][k]
        own = table.select(F.col("gram").alias("short"), F.log("p").alias("own"))
        tried = common.staged(left.join(own, "short", "left"), "tried")
        done.append(tried.where("own IS NOT NULL").select(
            "gram", (F.col("log_p") + F.col("own")).alias("log_p")))
        left = tried.where("own IS NULL")
        if k == 1:
            done.append(left.select("gram", F.col("log_p") + F.lit(model["floor"])))
            break
        weights = table.select("context", F.log("weight").alias("more")).distinct()
        left = left.withColumn("context", F.shiftright("short", BITS)).join(
            weights, "context", "left").select(
            "gram", (F.col("short") % (1 << BITS * (k - 1))).alias("short"),
            (F.col("log_p") + F.coalesce("more", F.lit(0.0))).alias("log_p"))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


# --- scoring ------------------------------------------------------------------------------

_SUMS = ("__lost", "__lost_squares", "__new", "__new_squares")
_MISSED = T.ArrayType(T.StructType(
    [T.StructField(c, T.LongType()) for c in ("gram", "n", "first")]))


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """`docs` with __n, the number of symbols, and mean and standard deviation of -log p, of
    all n-grams (__mean, __spread) and with remembered ones as 0 (__fresh, __fresh_spread);
    null without text."""
    rest = model is not None and "rest" in model
    shared = docs.sparkSession.sparkContext.broadcast(
        model and {k: v for k, v in model.items() if k != "rest"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            measured, missed, at = [], [], 0
            for group in _blocks(texts):
                measured += _measured(group, shared.value, missed, at)
                at += len(group)
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["__n"] = pa.array([m[0] for m in measured], pa.int64())
            for i, name in enumerate(_SUMS, 1):
                columns[name] = pa.array([m[i] for m in measured], pa.float64())
            if rest:
                columns["__missed"] = _lists(missed, len(texts))
            yield pa.RecordBatch.from_pydict(columns)

    scored = docs.mapInArrow(run, common.extended(
        docs.schema, __n="long", **{name: "double" for name in _SUMS},
        **({"__missed": _MISSED} if rest else {})))
    if rest:
        scored = _completed(scored, model)
    n = F.nullif(F.col("__n"), F.lit(0))

    def spread(squares: str, mean: str):
        return F.sqrt(F.greatest(F.col(squares) / n - F.col(mean) * F.col(mean), F.lit(0.0)))

    return (scored.withColumns({"__mean": F.col("__lost") / n, "__fresh": F.col("__new") / n})
            .withColumns({"__spread": spread("__lost_squares", "__mean"),
                          "__fresh_spread": spread("__new_squares", "__fresh")}).drop(*_SUMS))


def _completed(scored: DataFrame, model: dict) -> DataFrame:
    """The sums with what the n-grams add that are not in memory."""
    scored = common.staged(scored.withColumn("__row", F.monotonically_increasing_id()), "held")
    missed = scored.select("__row", F.inline("__missed"))
    lost = common.staged(looked_up(missed.select("gram").distinct(), model), "lost")
    x = -F.col("log_p")
    terms = (F.col("n") * x, F.col("n") * x * x, F.col("first") * x, F.col("first") * x * x)
    more = missed.join(lost, "gram").groupBy("__row").agg(
        *(F.sum(term).alias(f"more{name}") for name, term in zip(_SUMS, terms)))
    return (scored.drop("__missed").join(more, "__row", "left")
            .withColumns({name: F.col(name) + F.coalesce(f"more{name}", F.lit(0.0))
                          for name in _SUMS})
            .drop("__row", *(f"more{name}" for name in _SUMS)))


def _lists(missed: list[tuple], rows: int) -> pa.Array:
    """For each text its n-grams that are not in memory, from (texts, n-grams, n, first)."""
    owner, *values = (np.concatenate(c) for c in zip(*missed)) if missed else [np.zeros(0, int)] * 4
    ends = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
        [pa.array(v.astype(np.int64)) for v in values], ["gram", "n", "first"]))


def _blocks(texts: list[str | None]) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        text = text or ""
        if group and size + len(text) > BLOCK:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


def _measured(group: list[str], model: dict | None, missed: list[tuple], at: int) -> list[tuple]:
    """Number of symbols and sums for each text of a group, the first of which is text `at` of
    its batch; n-grams that are not in memory add nothing and go to `missed`."""
    if model is None:
        return [(len(t), 0.0, 0.0, 0.0, 0.0) if t.split() else (0, *[None] * 4) for t in group]
    found = [symbols(t, model["table"]) for t in group]
    sizes = np.array([len(f) for f in found])
    grams = np.concatenate([keys(f, model["order"]) for f in found])
    owner = np.repeat(np.arange(len(group)), sizes)
    place = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sums = np.zeros((4, len(group)))
    step = BLOCK if len(group) == 1 else max(len(grams), 1)  # whole windows of every text
    for i in range(0, len(grams), step):
        part, of = grams[i:i + step], owner[i:i + step]
        first = first_in_window(part, of, place[i:i + step])
        if 1 in model["orders"]:
            lost = -log_probabilities(part, model)
        else:
            known, logs = model["orders"][model["order"]]
            where, hit = _place(known, part)
            lost = np.zeros(len(part))
            lost[hit] = -logs[where[hit]]
            missed.append(_distinct(of[~hit] + at, part[~hit], first[~hit]))
        fresh = lost * first
        sums += [np.bincount(of, x, len(group)) for x in (lost, lost * lost, fresh, fresh * fresh)]
    return [row if row[0] else (0, *[None] * 4)
            for row in zip(sizes.tolist(), *(x.tolist() for x in sums))]


def _distinct(owner: np.ndarray, grams: np.ndarray, first: np.ndarray) -> tuple:
    """Each text's n-grams once, with how often they occur and how often first in a window."""
    order = np.lexsort((grams, owner))
    owner, grams, first = owner[order], grams[order], np.cumsum(first[order])
    end = np.ones(len(grams), bool)
    end[:-1] = (owner[1:] != owner[:-1]) | (grams[1:] != grams[:-1])
    end = np.flatnonzero(end)
    return owner[end], grams[end], np.diff(end, prepend=-1), np.diff(first[end], prepend=0)


def first_in_window(grams: np.ndarray, owner: np.ndarray, place: np.ndarray) -> np.ndarray:
    """True where an n-gram occurs first in its window of its text."""
    window = owner.astype(np.uint64) << np.uint64(40) | (place // WINDOW).astype(np.uint64)
    seen = words.mix(words.mix(window + np.uint64(1)) + grams.view(np.uint64))
    order = np.argsort(seen, kind="stable")
    out = np.ones(len(grams), bool)
    out[order[1:]] = seen[order[1:]] != seen[order[:-1]]
    return out


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__trusted"))
            .agg(F.min("quality").alias("q")).where("q = 1").select("__trusted"))


def quartiles(values: DataFrame) -> DataFrame:
    """First and third quartile (q1, q3) of `x` for each `lang` and `kind`: the values of rank
    n / 4 and 3 n / 4, rounded up. Counts of narrow bins tell which bin has that rank, and the
    bin's own values which of them it is."""
    group = ("lang", "kind")
    same = [F.col(f"v.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*group, "bin")]
    binned = values.withColumn("bin", F.floor(F.col("x") * BINS))
    upto = Window.partitionBy(*group).orderBy("bin")
    of_group = Window.partitionBy(*group)
    bins = (binned.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("k"))
            .withColumns({"upto": F.sum("k").over(upto), "n": F.sum("k").over(of_group)})
            .withColumn("quarter", F.explode(F.array(F.lit(1), F.lit(3))))
            .withColumn("rank", F.ceil(F.col("quarter") * F.col("n") / 4))
            .where("upto - k < rank AND rank <= upto"))
    inner = Window.partitionBy("lang", "kind", "quarter").orderBy("x")
    found = (binned.alias("v").join(F.broadcast(bins.alias("w")), same)
             .groupBy("v.lang", "v.kind", "w.quarter", "v.x", (F.col("w.rank") - F.col("w.upto")
                                                             + F.col("w.k")).alias("place"))
             .agg(F.count(F.lit(1)).alias("m")).withColumn("last", F.sum("m").over(inner))
             .where("last - m < place AND place <= last"))
    return found.groupBy(*group).agg(F.max(F.when(F.col("quarter") == 1, F.col("x"))).alias("q1"),
                                     F.max(F.when(F.col("quarter") == 3, F.col("x"))).alias("q3"))


def judge(docs: DataFrame, labels: DataFrame, lang: str = "lang", held: int = HELD) -> DataFrame:
    """`docs` (doc_id, text and a language column at least) with __n, __perplexity,
    __threshold, __fresh_perplexity, __fresh_threshold and __kept."""
    trusted = trusted_ids(labels)
    own = docs.select("doc_id", "text").where("text IS NOT NULL")
    model = fit(own.join(trusted.hint("shuffle_hash"),  # texts are moved, not sorted
                         F.col("doc_id") == F.col("__trusted"), "left_semi"), held=held)
    scored = common.staged(score(docs, model), "scored")
    good = (scored.where("__n > 0")
            .select("doc_id", F.col(lang).alias("__lang"), "__mean", "__fresh")
            .join(trusted, F.col("doc_id") == F.col("__trusted"), "left_semi"))
    values = good.select(
        F.explode(F.array_distinct(F.array("__lang", F.lit(None).cast("string")))).alias("lang"),
        "__mean", "__fresh").select("lang", F.inline(F.array(
            F.struct(F.lit("above").alias("kind"), F.col("__mean").alias("x")),
            F.struct(F.lit("below").alias("kind"), F.col("__fresh").alias("x")))))
    fence = F.lit(FENCE) * (F.col("q3") - F.col("q1"))
    values = common.staged(values, "trusted")
    fences = quartiles(values).groupBy("lang").agg(
        F.max(F.when(F.col("kind") == "above", F.col("q3") + fence)).alias("above"),
        F.max(F.when(F.col("kind") == "below", F.col("q1") - fence)).alias("below"))
    limits = {r["lang"]: (r["above"], r["below"]) for r in fences.collect()}  # a row a language
    common.unstage(values)
    overall = limits.pop(None, (None, None))

    def limit(i: int):
        out = F.lit(overall[i]).cast("double")
        for name, value in limits.items():
            out = F.when(F.col(lang) == name, F.lit(value[i])).otherwise(out)
        return F.exp(out)

    least = F.exp(F.col("__mean") - CHANCE * F.col("__spread") / F.sqrt("__n"))
    most = F.exp(F.col("__fresh") + CHANCE * F.col("__fresh_spread") / F.sqrt("__n"))
    return (scored.withColumns({"__threshold": limit(0), "__fresh_threshold": limit(1),
                                "__perplexity": F.exp("__mean"),
                                "__fresh_perplexity": F.exp("__fresh")})
            .withColumn("__kept", (F.col("__n") > 0)
                        & F.coalesce(least <= F.col("__threshold"), F.lit(True))
                        & F.coalesce(most >= F.col("__fresh_threshold"), F.lit(True))))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of `docs` that the classifier keeps, with the columns as they are."""
    return common.unbundled(judge(common.bundled(docs), labels).where("__kept"), docs)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = judge(docs, common.table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", F.col("__n").alias("n_symbols"),
                        F.col("__perplexity").alias("perplexity"),
                        F.col("__threshold").alias("threshold"),
                        F.col("__fresh_perplexity").alias("fresh_perplexity"),
                        F.col("__fresh_threshold").alias("fresh_threshold"),
                        F.col("__kept").alias("kept"))
