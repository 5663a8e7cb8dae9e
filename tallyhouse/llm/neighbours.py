"""Approximate nearest neighbours by cross-polytope hashing.

A vector is rotated by fast pseudo-rotations, three rounds of random signs and a Hadamard transform, and
goes to the nearest signed axis.  ``functions`` such axes make the bucket of one table; there are
``TABLES`` independent tables.  A query visits, in every table, its ``probes`` most promising buckets:
signed axes in the order of the query's coordinates along them.  All candidates there are compared
exactly, in double precision, in blocks.

``functions`` follows the number of rows, so that buckets hold about ``BUCKET_ROWS``.  ``probes`` is
measured, not guessed: the true neighbours of ``SAMPLE`` queries are found by exact blocked products over
all rows, and the fewest probes are taken that find ``RECALL`` of them.  If no number of probes up to
``MAX_PROBES`` does, a function less is used.  Queries that find too few candidates are answered exactly.

Scale: equal vectors are one entry that keeps its smallest ids, so copies do not fill a bucket.  A bucket
is cut into blocks of ``BLOCK`` entries and of as many queries, whatever its size, and each pair of blocks
is held alone.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; rows that repeat an id with an equal vector count once, and rows with the query's
id are its own; ties go to the smaller id; with fewer candidates than asked for, all are returned; an
empty table gives no rows.  Null ids take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.llm.stream import group_bounds, sorted_groups
from tallyhouse.session import materialize

TABLES, BUCKET_ROWS, BLOCK = 4, 400, 2048
SAMPLE, RECALL, MAX_PROBES = 256, 0.96, 4096
SEED = 20240611


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


class Hashes:
    """Tables of ``functions`` cross-polytope hashes each, for vectors of ``dims`` components."""

    def __init__(self, dims: int, functions: int, tables: int = TABLES):
        self.dims, self.functions, self.tables = dims, functions, tables
        self.width = 1 << max(1, (dims - 1).bit_length())
        self.signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (tables, functions, 3, self.width))

    def _rotated(self, x: np.ndarray, t: int, f: int) -> np.ndarray:
        y = np.zeros((len(x), self.width))
        y[:, : self.dims] = x / np.linalg.norm(x, axis=1, keepdims=True)
        for s in self.signs[t, f]:
            y = hadamard(y * s)
        return y

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket of each row in each table."""
        out = np.zeros((len(x), self.tables), np.int64)
        for t in range(self.tables):
            for f in range(self.functions):
                y = self._rotated(x, t, f)
                axis = np.abs(y).argmax(axis=1)
                out[:, t] = out[:, t] * 2 * self.width + 2 * axis + (y[np.arange(len(y)), axis] < 0)
        return out

    def probes(self, x: np.ndarray, t: int, most: int) -> np.ndarray:
        """Buckets of table ``t`` in the order in which the rows should visit them."""
        best, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for f in range(self.functions):
            y = self._rotated(x, t, f)
            signed = np.stack([y, -y], axis=2).reshape(len(x), -1)  # 2 * axis + sign
            order = np.argsort(-signed, axis=1, kind="stable")[:, :most]
            loss = signed.max(axis=1, keepdims=True) - np.take_along_axis(signed, order, 1)
            total = (cost[:, :, None] + loss[:, None, :] ** 2).reshape(len(x), -1)
            code = (best[:, :, None] * 2 * self.width + order[:, None, :]).reshape(len(x), -1)
            first = np.argsort(total, axis=1, kind="stable")[:, :most]
            best, cost = np.take_along_axis(code, first, 1), np.take_along_axis(total, first, 1)
        return best


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of doubles out of an array column without nulls and of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``; depends on these two rows only."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def nearest_in_block(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int):
    """``query row, candidate row, score`` of the k nearest, ties to the smaller id."""
    near = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
    if near.shape[1] > k:
        edge = np.partition(near, -k, axis=1)[:, -k]
        at, who = np.nonzero(near >= edge[:, None] - 1e-9)  # products of blocks round in other ways
    else:
        at, who = np.nonzero(np.ones(near.shape, bool))
    score = cosines(q[at], c[who])
    order = np.lexsort((ids[who], -score, at))
    at, who, score = at[order], who[order], score[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < k
    return at[keep], who[keep], score[keep]


def entries(vectors: DataFrame, vec_id: str, embedding: str, keep: int) -> tuple[DataFrame, DataFrame]:
    """``gid, ids, v``: distinct vectors with their smallest ids; and ``id, v`` of all valid rows."""
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.transform(F.col(embedding), lambda x: x.cast("double")).alias("v")).where(
        F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return None, None
    rows = rows.where(F.size("v") == usual["n"]).dropDuplicates(["id", "v"])
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("gid"), "ids", "v"), rows


def _exact(index: DataFrame, queries: np.ndarray, k: int) -> DataFrame:
    """``q, gid, v, score`` of the nearest entries of a bounded list of queries, over all rows in blocks."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                c, ids = matrix(batch.column(1)), batch.column(0).to_numpy()
                at, who, score = nearest_in_block(shared.value, c, ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(ids[who]), batch.column(1).take(pa.array(who)), pa.array(score)], ["q", "gid", "v", "score"])

    found = index.select("gid", "v").mapInArrow(run, "q long, gid long, v array<double>, score double")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "gid"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def tune(index: DataFrame, sample: np.ndarray, n: int, k: int) -> tuple[Hashes, int]:
    """Hashes and number of probes that find ``RECALL`` of the sample's true neighbours."""
    dims = sample.shape[1]
    width = 2 << max(1, (dims - 1).bit_length())
    functions = min(8, max(1, int(math.log(max(n / BUCKET_ROWS, 1)) / math.log(width))))
    true = _exact(index, sample, k).select("q", "v").collect()  # at most SAMPLE x k rows
    q = np.array([r["q"] for r in true])
    wanted = np.array([r["v"] for r in true])
    while True:
        hashes = Hashes(dims, functions)
        most = min(MAX_PROBES, (2 * hashes.width) ** functions)
        place = np.full(len(q), most)
        homes = hashes.buckets(wanted)
        for t in range(hashes.tables):
            visits = hashes.probes(sample, t, most)
            hit = visits[q] == homes[:, t][:, None]
            place = np.minimum(place, np.where(hit.any(axis=1), hit.argmax(axis=1), most))
        need = int(np.sort(place)[min(len(place) - 1, math.ceil(RECALL * len(place)) - 1)]) + 1
        if need <= most or functions == 1:
            return hashes, min(need, most)
        functions -= 1


def _compare(k: int):
    keys = ["t", "bucket", "i", "j"]

    def run(batches):
        for table in sorted_groups(batches, keys):
            at = group_bounds(table, keys)
            asks, ids = table.column("asks").to_numpy(), table.column("gid").to_numpy()
            v = matrix(table.column("v").combine_chunks())
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                q, c = np.flatnonzero(asks[lo:hi]) + lo, np.flatnonzero(~asks[lo:hi]) + lo
                if len(q) and len(c):
                    a, b, score = nearest_in_block(v[q], v[c], ids[c], k)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[q[a]]), pa.array(ids[c[b]]), pa.array(score)], ["qid", "gid", "score"])

    return run, "qid long, gid long, score double"


def _found(index: DataFrame, asking: DataFrame, hashes: Hashes, probes: int, tables: int, k: int) -> DataFrame:
    """``qid, gid, score`` out of the visited buckets."""
    names = ["t", "bucket", "gid", "v"]

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                homes = hashes.buckets(matrix(batch.column(1)))
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(homes), t, np.int32)), pa.array(homes[:, t]), batch.column(0), batch.column(1)], names)

    def ask(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                some = batch.slice(lo, 64)
                for t in range(tables):
                    visits = hashes.probes(matrix(some.column(1)), t, probes)
                    rows = pa.array(np.repeat(np.arange(len(visits)), visits.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(visits.size, t, np.int32)), pa.array(visits.ravel()), some.column(0).take(rows), some.column(1).take(rows)], names
                    )

    schema = "t int, bucket long, gid long, v array<double>"
    homes = index.select("gid", "v").mapInArrow(place, schema)
    visits = asking.select("gid", "v").mapInArrow(ask, schema)
    # how many blocks a bucket needs on either side
    many = homes.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("ni"))
    many = many.join(visits.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nj")), ["t", "bucket"])
    many = materialize(many, "neighbours-blocks")

    def blocks(rows, own, count_own, other, count_other, asks):
        return (
            rows.join(many, ["t", "bucket"])
            .withColumn(own, F.pmod(F.xxhash64("gid"), F.col(count_own)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(count_other) - 1)))
            .select("t", "bucket", "i", "j", F.lit(asks).alias("asks"), "gid", "v")
        )

    both = blocks(homes, "i", "ni", "j", "nj", False).unionByName(blocks(visits, "j", "nj", "i", "ni", True))
    run, schema = _compare(k)
    keys = ["t", "bucket", "i", "j"]
    return both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema).distinct()


def search(vectors: DataFrame, is_query, k: int = 5, vec_id="vec_id", embedding="embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for each row that ``is_query``
    (a condition on the column ``id``) selects."""
    spark = vectors.sparkSession
    groups = k + 1  # the query's own entry may be among them
    index, rows = entries(vectors, vec_id, embedding, k + 1)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    index = materialize(index, "neighbours-index")
    n = index.count()
    asked = materialize(rows.where(is_query).join(index.select("gid", "v"), "v").select(F.col("id").alias("query_id"), F.col("gid").alias("qid")), "neighbours-queries")
    asking = index.join(asked.select(F.col("qid").alias("gid")).distinct(), "gid", "left_semi")
    sample = asking.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    hashes, probes = tune(index, np.array([r["v"] for r in sample]), n, groups)

    found = materialize(_found(index, asking, hashes, probes, hashes.tables, groups), "neighbours-found")
    short = asking.join(found.groupBy("qid").count().where(F.col("count") >= min(groups, n)).select(F.col("qid").alias("gid")), "gid", "left_anti")
    if short.limit(1).count():
        # all buckets of one table of one function: every entry is a candidate
        simple = Hashes(len(sample[0]["v"]), 1, 1)
        found = found.unionByName(_found(index, short, simple, 2 * simple.width, 1, groups)).distinct()

    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "gid"))
    best = found.withColumn("place", place).where(F.col("place") <= groups).drop("place")
    every = best.join(index.select("gid", "ids"), "gid").join(asked, "qid").select("query_id", "score", F.explode("ids").alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        every.where("vec_id <> query_id").distinct().withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op1(spark, vectors: DataFrame) -> DataFrame:
    return search(vectors, F.col("id") % 50 == 0)
