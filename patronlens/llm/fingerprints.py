"""Document fingerprints that follow edit distance: Order MinHash, in built-in functions only.

The k-mers of a text are its pairs of neighbouring words, numbered where they occur again. A
fingerprint has `SLOTS` places. For each place the two smallest numbered k-mers under the
place's hash function are taken, put back into text order, and hashed as a pair, so that a
place agrees only where two texts share these k-mers and their order. The hash functions are
one random hash read from different starting points of its range, the smallest values being the next
ones upward, around the end; one sorted array then serves all places.

Everything happens inside a row: arrays of longs that hold a hash in the upper 40 bits and the
position in the lower 24 (beyond 16 million words, the position modulo that).

A document's neighbour (the next one in descending doc_id) comes from windows over ranges of
doc_id: at most `MAX_RANGES` bounds are taken from quantiles, and the first document of each
range is also sent to the range before it. Texts move once.

Defined cases: null text counts as empty; a text of one word or none has itself as its only
k-mer; a single document is its own neighbour; rows with equal doc_id follow each other by
text; rows without doc_id come last."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from patronlens.llm import common

SLOTS = 64
MAX_RANGES = 65_536
RANGE_ROWS = 4_096
DIGITS = 8

_LOWEST = -(1 << 63)


def fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """`docs` with the fingerprint of a text column: SLOTS hashes of eight hex digits."""
    bits = SLOTS.bit_length() - 1
    steps = [
        {"__w": rf"split({text}, '[ \\x09-\\x0D]+')"},
        {"__n": "greatest(size(__w) - 1, 1)",
         "__k": f"""if(size(__w) < 2, array(shiftleft(xxhash64({text}), 24)),
                    transform(sequence(0, size(__w) - 2), i ->
                        shiftleft(xxhash64(get(__w, i), get(__w, i + 1)), 24) | (i & 16777215)))"""},
        {"__s": "sort_array(__k)"},
        # where runs of equal k-mers begin
        {"__r": """filter(sequence(0, __n - 1), i -> i = 0 OR
                    shiftright(get(__s, i), 24) != shiftright(get(__s, i - 1), 24))"""},
        # hash of (k-mer, number of the occurrence), with the position of that occurrence
        {"__e": """sort_array(flatten(transform(__r, (a, j) -> transform(
                    sequence(a, coalesce(get(__r, j + 1), __n) - 1), i ->
                        shiftleft(xxhash64(shiftright(get(__s, i), 24), i - a), 24)
                        | (get(__s, i) & 16777215)))))"""},
        # the first element of each of SLOTS equal parts of the hash range, where there is one
        {"__b": f"""filter(sequence(0, __n - 1), i -> i = 0 OR
                    shiftright(get(__e, i), {64 - bits}) != shiftright(get(__e, i - 1), {64 - bits}))"""},
        {"__p": f"transform(__b, i -> shiftright(get(__e, i), {64 - bits}) + {SLOTS // 2})"},
        {"__i": f"""transform(sequence(0, {SLOTS - 1}), s -> CAST(coalesce(
                    get(__b, CAST(nullif(array_position(__p, CAST(s AS BIGINT)), 0) AS INT) - 1),
                    get(filter(__b, (i, j) -> get(__p, j) >= s), 0), 0) AS INT))"""},
        {"__t": """transform(__i, i -> struct(get(__e, i) AS x, get(__e, (i + 1) % __n) AS y))"""},
        {name: f"""array_join(transform(__t, t -> lpad(right(hex(if(
                    (t.x & 16777215) <= (t.y & 16777215),
                    xxhash64(shiftright(t.x, 24), shiftright(t.y, 24)),
                    xxhash64(shiftright(t.y, 24), shiftright(t.x, 24)))), {DIGITS}), {DIGITS}, '0')), '')"""},
    ]
    out = docs
    for step in steps:
        out = out.withColumns({k: F.expr(v) for k, v in step.items()})
    return out.drop(*(k for step in steps[:-1] for k in step))


def likeness(a: str, b: str) -> Column:
    """Share of places at which two fingerprints agree."""
    return F.expr(f"""size(filter(sequence(0, {SLOTS - 1}), i ->
        substring({a}, i * {DIGITS} + 1, {DIGITS}) = substring({b}, i * {DIGITS} + 1, {DIGITS})))
        / {SLOTS}D""")


def _ranges(docs: DataFrame) -> tuple[Column, Column, DataFrame]:
    """The number of the range of doc_id that a row lies in (ascending), as an expression of
    __key, and for the largest key of every range the range whose rows it follows."""
    keys = docs.select("__key")
    rows = keys.count()
    wanted = min(MAX_RANGES, max(1, rows // RANGE_ROWS))
    side = max(1, math.isqrt(wanted))
    shares = [i / (side * side) for i in range(1, side * side)]
    bounds = sorted(set(keys.agg(F.percentile_approx(
        "__key", shares, 100 * side * side).alias("b")).first().b or [])) if shares else []
    # two levels, so that a row is compared with a few hundred bounds at most
    groups = [bounds[i:i + side] for i in range(0, len(bounds), side)] or [[]]
    tops = F.array(*(F.lit(g[-1]) for g in groups if g)).cast("array<bigint>")
    inner = F.array(*(F.array(*map(F.lit, g)).cast("array<bigint>") for g in groups))
    top = F.size(F.filter(tops, lambda b: b < F.col("__key")))
    low = F.size(F.filter(F.coalesce(F.get(inner, F.col("__top")), F.array().cast("array<bigint>")),
                          lambda b: b < F.col("__key")))
    bucket = F.col("__top") * side + low
    heads = keys.withColumn("__top", top).select("__key", bucket.alias("__bucket")).groupBy(
        "__bucket").agg(F.max("__key").alias("__key"))
    found = sorted((r["__bucket"], r["__key"]) for r in heads.collect())  # a row for each range
    follows = [(key, found[(i + 1) % len(found)][0]) for i, (_, key) in enumerate(found)]
    return top, bucket, docs.sparkSession.createDataFrame(
        follows, "__key long, __guest int")


def with_neighbour(docs: DataFrame, kept: list[str], prepare) -> DataFrame:
    """Rows of `docs` (doc_id, text, ...) after `prepare`, with the columns `kept` of the next
    row in descending doc_id as next_*; the last row is followed by the first."""
    keyed = docs.withColumn("__key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)))
    top, bucket, follows = _ranges(keyed)
    placed = (keyed.join(F.broadcast(follows), "__key", "left")
              .withColumn("__top", top).withColumn("__bucket", bucket)
              .withColumn("__to", F.explode(F.array_compact(F.array(
                  F.struct(F.col("__bucket").cast("int").alias("bucket"), F.lit(False).alias("guest")),
                  F.when(F.col("__guest").isNotNull(), F.struct(
                      F.col("__guest").alias("bucket"), F.lit(True).alias("guest")))))))
              .select("*", "__to.bucket", "__to.guest")
              .drop("__to", "__top", "__bucket", "__guest"))
    ready = prepare(placed.repartition("bucket"))
    order = Window.partitionBy("bucket").orderBy("guest", F.desc("__key"), "text")
    return (ready.withColumns({f"next_{c}": F.lead(c).over(order) for c in kept})
            .where("NOT guest").drop("bucket", "guest", "__key"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"))
    both = with_neighbour(docs, ["text", "fingerprint"],
                          lambda rows: fingerprint(rows, "text", "fingerprint"))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut),
                      F.substring("next_text", F.lit(1), cut))
    rows = both.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"),
                       "fingerprint", "next_fingerprint")
    return fingerprint(rows, "edited", "edited_fingerprint").select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"))
