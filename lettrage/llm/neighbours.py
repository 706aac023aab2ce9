"""Approximate nearest neighbours by shifted Hilbert curves.

Vectors are projected on ``DIMENSIONS`` random directions per curve, the projections are brought to even spread by quantiles
of a sample of at most ``SAMPLE`` vectors in expectation, shifted at random and numbered along a Hilbert curve. Spark
range-partitions all curves by their keys; the sorted rows get their rank along the curve and fall into blocks. A query
reads the blocks that its window of ``SHARE`` of all vectors around its own rank touches, on every curve; the best of all
windows are merged, and their scores are inner products in double precision.

Equal vectors are one row of the index, with their least ``vec_id``s, as many as an answer can hold; what is found is spelled
out into these ids, and every query that is a copy takes the answer of its vector, but for itself.

Recall on vectors without structure needs windows in proportion to the table: with 14 curves and a tenth of the table per
curve, windows cover about three quarters of it. Blocks have a fixed size, and blocks with many queries are dealt out in
parts, so memory per task doesn't grow with the table.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of each length
are searched by themselves, as products need equal lengths, one index after another; equal scores are ordered by ``vec_id``; of rows with
equal ``vec_id`` the least vector counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettrage.llm.shared import stored

NEAREST = 20
CURVES, DIMENSIONS, BITS = 14, 4, 10
SHARE = 0.1
SHIFT = 0.3
SAMPLE = 20_000
BLOCK = 8192
#: Queries of a block that one part takes.
PART = 4096
SEED = 20
#: Copies of a vector are counted out in so many parts first.
SALTS = 8
#: Queries with equal vectors from which, and the share of all queries above which, their answer is broadcast to them.
CROWD, CROWD_SHARE = 8, 0.001


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (n, d) with ``bits`` bits per axis: Gray-code axes are unwound
    from the highest bit down, then their bits are interleaved."""
    x = cells.astype(np.uint64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        top, below = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for axis in range(axes):
            on = (x[axis] & top) > 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(on, below, swap)
            x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint64(1 << level)) > 0, np.uint64((1 << level) - 1), np.uint64(0))
    x ^= flip
    keys = np.zeros(x.shape[1], dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            keys = keys << np.uint64(1) | (x[axis] >> np.uint64(level)) & np.uint64(1)
    return keys.astype(np.int64)


@dataclass
class Curves:
    """Directions and shifts of each curve, and quantiles of each direction."""

    directions: np.ndarray  # curve, size, dimension
    shifts: np.ndarray  # curve, dimension
    quantiles: np.ndarray  # curve, dimension, point

    @classmethod
    def fit(cls, sample: np.ndarray, curves: int, seed: int = SEED) -> Curves:
        rng = np.random.default_rng(seed)
        size = sample.shape[1]
        kept = min(DIMENSIONS, size)
        directions = np.stack([np.linalg.qr(rng.normal(size=(size, kept)))[0] for _ in range(curves)])
        projected = np.einsum("ns,csd->cdn", sample, directions)
        quantiles = np.quantile(projected, np.linspace(0, 1, 257), axis=2).transpose(1, 2, 0)
        return cls(directions, rng.random((curves, kept)), quantiles)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(curve, vector) -> key."""
        marks = np.linspace(0, 1, self.quantiles.shape[2])
        out = []
        for directions, shifts, quantiles in zip(self.directions, self.shifts, self.quantiles):
            y = vectors @ directions
            even = np.stack([np.interp(y[:, k], quantiles[k], marks) for k in range(y.shape[1])], 1)
            cells = ((even * (1 - SHIFT) + shifts * SHIFT) * ((1 << BITS) - 1)).astype(np.int64)
            out.append(hilbert_keys(cells, BITS))
        return np.stack(out)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``vector`` (array of double) of the vectors that take part."""
    whole = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = whole.filter(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.coalesce(F.exists("vector", odd), F.lit(True))
        & F.exists("vector", lambda x: x != 0)
    )
    return fine.groupBy("vec_id").agg(F.min(F.struct(F.size("vector").alias("size"), F.col("vector").alias("vector"))).alias("least")).select("vec_id", "least.vector")


def least_ids(vectors: DataFrame, kept: int) -> DataFrame:
    """``vector, ids``: every distinct vector with its least ``vec_id``s, ``kept`` at most, in order."""
    few = vectors.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id", F.lit("salt")), F.lit(SALTS)).alias("salt"))
    for keys in (["vector", "salt"], ["vector"]):
        few = few.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).filter(F.col("nth") <= kept).drop("nth")
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def ordered(vectors: DataFrame, curves: Curves) -> DataFrame:
    """``curve, rank, vec_id, vector`` (bytes of doubles), ``asks``: every vector on every curve, ranked from 0 along it."""
    shared = vectors.sparkSession.sparkContext.broadcast(curves)

    def place(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x = np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)
                data = pa.array([row.tobytes() for row in x], pa.binary())
                for curve, keys in enumerate(shared.value.keys(x)):
                    number = pa.array(np.full(len(keys), curve, dtype=np.int32))
                    columns = [number, pa.array(keys), batch.column(0), data, batch.column(2)]
                    yield pa.RecordBatch.from_arrays(columns, ["curve", "key", "vec_id", "vector", "asks"])

    keyed = vectors.select("vec_id", "vector", "asks").mapInArrow(place, "curve int, key bigint, vec_id bigint, vector binary, asks boolean")
    dealt = keyed.repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
    rows = stored(dealt.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "curves")
    # One row per curve and partition: what a partition's rows of a curve add to their own places.
    parts = rows.groupBy("curve", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return rows.join(F.broadcast(bases), ["curve", "part"]).select("curve", (F.col("row") + F.col("base")).alias("rank"), "vec_id", "vector", "asks")


def best_in_blocks(dealt: DataFrame, nearest: int) -> DataFrame:
    """``query_id, vec_id, score`` of the nearest of each query, itself included, in each block and curve. Rows come sorted by block with its
    vectors before its queries; queries are answered as they come."""
    def search(batches):
        import pyarrow as pa

        block, ids, vectors = None, [], []
        known = None  # ids and vectors of the block once its queries come

        def answer(queries, asked):
            own_ids, own, small, scale = known
            rough = asked.astype(np.float32) @ small.T
            count = min(nearest, len(own_ids))
            least = np.partition(rough, len(own_ids) - count, axis=1)[:, len(own_ids) - count]
            margin = 1e-5 * np.linalg.norm(asked, axis=1) * scale
            line, column = np.nonzero(rough >= np.where(np.isfinite(least), least - margin, np.finfo(np.float32).min)[:, None])
            scores = (asked[line] * own[column]).sum(1)
            order = np.lexsort((own_ids[column], -scores, line))
            line, column, scores = line[order], column[order], scores[order]
            starts = np.searchsorted(line, np.arange(len(queries)))
            keep = np.arange(len(line)) - starts[line] < nearest
            return pa.RecordBatch.from_arrays(
                [pa.array(queries[line[keep]]), pa.array(own_ids[column[keep]]), pa.array(scores[keep])], ["query_id", "vec_id", "score"]
            )

        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                if not batch.num_rows:
                    continue
                keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)], 1)
                role, vec_ids = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False)
                x = np.frombuffer(b"".join(batch.column(5).to_pylist()), dtype=np.float64).reshape(batch.num_rows, -1)
                edges = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1) | (role[1:] != role[:-1]), [True]]))
                for lo, hi in zip(edges[:-1], edges[1:]):
                    if block != tuple(keys[lo]):
                        block, ids, vectors, known = tuple(keys[lo]), [], [], None
                    if role[lo] == 0:
                        ids.append(vec_ids[lo:hi])
                        vectors.append(x[lo:hi])
                    elif ids:
                        if known is None:
                            own = np.concatenate(vectors)
                            known = np.concatenate(ids), own, own.astype(np.float32), np.linalg.norm(own, axis=1).max()
                        yield answer(vec_ids[lo:hi], x[lo:hi])

    return dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score double")


def search(vectors: DataFrame, is_query: Column, nearest: int = NEAREST, curves: int = CURVES, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``nearest`` best of every query's windows; ``is_query`` reads ``vec_id``."""
    fine = stored(usable(vectors), "vectors")
    sizes = [r["size"] for r in fine.groupBy(F.size("vector").alias("size")).count().orderBy("size").collect()]
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    each = [search_length(fine.filter(F.size("vector") == n) if len(sizes) > 1 else fine, is_query, nearest, curves, share, block) for n in sizes]
    return reduce(DataFrame.unionByName, each)


def search_length(fine: DataFrame, is_query: Column, nearest: int, curves: int, share: float, block: int) -> DataFrame:
    """The answers among vectors of one length."""
    queries = fine.filter(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    asked = stored(queries.groupBy("vector").agg(F.count(F.lit(1)).alias("queries")), "query-vectors")
    groups = least_ids(fine, nearest + 1).join(asked, "vector", "left")
    groups = stored(groups.select(F.col("ids")[0].alias("vec_id"), "vector", "ids", F.col("queries").isNotNull().alias("asks"), "queries"), "distinct-vectors")
    total = groups.count()
    chosen = groups.filter(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1_000_000)) < 1_000_000 * min(1.0, SAMPLE / total))
    sample = np.array([r["vector"] for r in chosen.select("vector").collect()] or [r["vector"] for r in groups.limit(1).collect()])
    placed = stored(ordered(groups, Curves.fit(sample, curves)), "ranks")
    asking, asked_by = groups.agg(F.count("queries"), F.coalesce(F.sum("queries"), F.lit(0))).first()
    half, last = int(np.ceil(total * share / 2)), (total - 1) // block
    parts = max(1, -(-int(asking * (block + 2 * half) / total) // PART))
    own = placed.select(
        "curve", F.floor(F.col("rank") / block).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        F.lit(0).alias("role"), "vec_id", "vector",
    )
    edge = lambda rank: F.greatest(F.lit(0), F.least(F.lit(last), F.floor(rank / block))).cast("int")
    asked = placed.filter("asks").select(
        "curve", F.explode(F.sequence(edge(F.col("rank") - half), edge(F.col("rank") + half))).alias("block"),
        F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("role"), "vec_id", "vector",
    )
    dealt = own.unionByName(asked).repartition("curve", "block", "part").sortWithinPartitions("curve", "block", "part", "role", "vec_id")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= nearest + 1)

    found = stored(best(best_in_blocks(dealt, nearest + 1)).dropDuplicates(["query_id", "rank", "vec_id"]), "found")
    copied = groups.filter(F.size("ids") > 1).select("vec_id", "ids")
    spelled = found.join(copied, "vec_id", "left").select("query_id", "score", F.explode(F.coalesce("ids", F.array("vec_id"))).alias("vec_id"))
    answers = best(spelled).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("answer"))
    answers = stored(answers.withColumnRenamed("query_id", "vec_id").join(groups.select("vec_id", "vector", "queries"), "vec_id").drop("vec_id"), "answers")
    crowded = F.col("queries") > max(CROWD, asked_by * CROWD_SHARE)
    crowds = F.broadcast(answers.filter(crowded).select("vector", "answer"))
    rest = queries.join(F.broadcast(answers.filter(crowded).select("vector")), "vector", "left_anti").join(answers.filter(~crowded).select("vector", "answer"), "vector")
    each = queries.join(crowds, "vector").unionByName(rest).select(
        "query_id", F.posexplode(F.slice(F.filter("answer", lambda a: a["vec_id"] != F.col("query_id")), 1, nearest)).alias("at", "a")
    )
    return each.select("query_id", (F.col("at") + 1).alias("rank"), "a.vec_id", "a.score")
