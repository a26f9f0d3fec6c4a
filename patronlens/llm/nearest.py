"""Approximate nearest neighbours: inverted lists with an adaptive scan of dimensions.

k-means centres, fitted on at most about `SAMPLE_ROWS` vectors, divide all vectors into lists; a
random rotation spreads the variance evenly over the dimensions. A query looks into its nearest lists;
there, squared distances grow by blocks of rotated columns, and after every block a
hypothesis test drops a candidate when its partial distance, scaled up to all dimensions, lies
beyond the tenth best so far by more than sampling error explains. What is left is ranked by
the Euclidean distance of the original vectors in double precision.

Lists are cut into blocks of rows (by a hash of vec_id), so a list that holds a third of all
vectors is scanned by many tasks; queries go to every block of the lists they probe. How many lists a
query probes is fitted too: the fewest that find `RECALL` of the sample's true neighbours.

Defined cases: null or empty vectors, vectors of zeros, and those with null, infinite or NaN
components take no part, neither do vectors of a length other than the most frequent one and
rows without vec_id; ties go to the smaller vec_id; rows that repeat a vec_id count once as a
query and each as a candidate of others; fewer candidates than asked for: all that are found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from patronlens.llm import common

SAMPLE_ROWS = 20_000
LIST_ROWS = 256
MOST_LISTS = 1024
RECALL = 0.985
SURE = 2.1  # standard errors of the test
COLUMNS = 16
SEED = 20240229


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0)
                   & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                              & (F.abs(x) < float("inf")))
                   & F.exists("v", lambda x: x != 0)))
    return rows


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def centres_of(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    random = np.random.default_rng(SEED)
    centres = sample[random.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        owner = _nearest(sample, centres, 1)[:, 0]
        counts = np.bincount(owner, minlength=lists)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        empty = counts == 0
        centres = np.where(empty[:, None], centres, sums / np.maximum(counts, 1)[:, None])
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, count: int) -> np.ndarray:
    out = np.empty((len(rows), count), np.int32)
    for i in range(0, len(rows), 4096):
        far = _squared(rows[i:i + 4096], centres)
        out[i:i + 4096] = np.argsort(far, axis=1, kind="stable")[:, :count]
    return out


def fit(rows: DataFrame, k: int, sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """Centres, rotation and number of lists to probe."""
    n = rows.count()
    if not n:
        return None
    part = rows if n <= sample_rows else rows.where(
        F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int((1 << 20) * sample_rows / n))
    sample = common.fetched(part.select("v", "vec_id").orderBy("vec_id"))["v"]
    sample = np.array(sample.tolist())
    lists = int(min(MOST_LISTS, max(1, n // LIST_ROWS), len(sample)))
    centres = centres_of(sample, lists)
    dims = sample.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))[0]
    owner = _nearest(sample, centres, 1)[:, 0]
    asked = sample[:: max(1, len(sample) // 400)]
    order = _nearest(asked, centres, lists)
    true = np.argsort(_squared(asked, sample), axis=1, kind="stable")[:, :k + 1]
    place = np.empty((len(asked), lists), np.int64)  # when a query comes to a list
    np.put_along_axis(place, order.astype(np.int64), np.arange(lists)[None, :].repeat(
        len(asked), 0), axis=1)
    visit = np.take_along_axis(place, owner[true].astype(np.int64), axis=1)
    probes = int(np.quantile(visit, RECALL, method="higher")) + 1
    return {"centres": centres, "rotation": rotation, "probes": min(probes, lists), "rows": n}


def _assign(shared, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _nearest(_matrix(batch.column("v")), shared.value["centres"], count)
                yield pa.RecordBatch.from_pydict({
                    "lists": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(found) + 1, dtype=np.int32) * count),
                        pa.array(found.ravel())),
                    "vec_id": batch.column("vec_id"), "v": batch.column("v")})

    return run


def scan(queries: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """For each (rotated) query the rows that may be among its k nearest. `own[i, j]` marks
    rows that are not candidates of a query."""
    n, dims = rows.shape
    head = min(n, max(4 * k, 64))
    first = _squared(queries, rows[:head])
    first[own[:, :head]] = np.inf
    bound = np.sort(first, axis=1)[:, min(k, head) - 1] if head >= k else np.full(len(queries), np.inf)
    bound = bound * (1 + 1e-9) + 1e-12
    q, c = np.nonzero(~own)
    partial = np.zeros(len(q))
    for d in range(0, dims, COLUMNS):
        if d == 0:  # nothing is dropped yet: the block as one product
            part = _squared(queries[:, :COLUMNS], rows[:, :COLUMNS])
            partial = part[q, c]
        else:
            gap = queries[q, d:d + COLUMNS] - rows[c, d:d + COLUMNS]
            partial = partial + np.einsum("ij,ij->i", gap, gap)
        seen = min(d + COLUMNS, dims)
        slack = 1.0 if seen == dims else (1 + SURE / np.sqrt(seen)) ** 2
        alive = partial * (dims / seen) <= bound[q] * slack
        q, c, partial = q[alive], c[alive], partial[alive]
    ends = np.searchsorted(q, np.arange(len(queries) + 1))
    return [c[ends[i]:ends[i + 1]] for i in range(len(queries))]


def _search(shared, k: int):
    def run(asked: pa.Table, listed: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asked.num_rows and listed.num_rows:
            rotation = shared.value["rotation"]
            ids, rows = listed.column("vec_id").to_numpy(), _matrix(listed.column("v"))
            turned = rows @ rotation
            wanted, vectors = asked.column("vec_id").to_numpy(), _matrix(asked.column("v"))
            for i in range(0, len(wanted), 64):
                part = vectors[i:i + 64]
                own = wanted[i:i + 64, None] == ids[None, :]
                for j, near in enumerate(scan(part @ rotation, turned, own, k)):
                    exact = np.sqrt(((rows[near] - part[j]) ** 2).sum(axis=1))
                    best = np.lexsort((ids[near], exact))[:k]
                    out.append((np.full(len(best), wanted[i + j]), ids[near][best], exact[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 3
        return pa.table({"query_id": pa.array(columns[0].astype(np.int64)),
                         "vec_id": pa.array(columns[1].astype(np.int64)),
                         "score": pa.array(columns[2].astype(float))})

    return run


def search(vectors: DataFrame, wanted, k: int = 10) -> DataFrame:
    """The k nearest other vectors of each row of `vectors` (vec_id, embedding) that the
    condition `wanted` selects: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    found = "query_id long, rank int, vec_id long, score double"
    rows = common.staged(usable(vectors), "vectors")
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = sizes.orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not usual:
        return spark.createDataFrame([], found)
    rows = rows.where(F.size("v") == usual[0].dims)
    model = fit(rows, k)
    shared = spark.sparkContext.broadcast(model)
    kind = "lists array<int>, vec_id long, v array<double>"
    listed = common.staged(rows.mapInArrow(_assign(shared, 1), kind).select(
        F.col("lists")[0].alias("list"), "vec_id", "v"), "listed")
    average = max(LIST_ROWS, 2 * model["rows"] // len(model["centres"]))
    blocks = (listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
              .select("list", F.ceil(F.col("n") / average).cast("int").alias("blocks")))
    blocks = F.broadcast(common.staged(blocks, "blocks"))  # a row for each of at most 1024 lists
    cut = listed.join(blocks, "list").select(
        "list", F.pmod(F.xxhash64("vec_id", F.lit(1)), "blocks").cast("int").alias("block"),
        "vec_id", "v")
    asked = (rows.where(wanted).dropDuplicates(["vec_id"])
             .mapInArrow(_assign(shared, model["probes"]), kind)
             .select(F.explode("lists").alias("list"), "vec_id", "v").join(blocks, "list")
             .select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                     "vec_id", "v"))
    near = (asked.groupBy("list", "block").cogroup(cut.groupBy("list", "block"))
            .applyInArrow(_search(shared, k), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
