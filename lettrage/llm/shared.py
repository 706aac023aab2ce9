"""Helpers of the training-data operators: shared folders, stored tables and column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``; only a local session may fall back to its own disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="lettrage-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """The frame written once as Parquet in a shared folder and read back: lost executors cost a read, not the work."""
    spark = frame.sparkSession
    path = shared_folder(spark, name)
    frame.write.parquet(path, compression=codec)
    return spark.read.schema(frame.schema).parquet(path)


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` as bigint and ``text`` with null as empty; other columns are left behind."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


#: Up to so many keys, 16 bytes each, are broadcast to leave documents out; more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The documents, all columns, but for those in ``rejected``: by ``doc_id``, null included, and by ``body``, the hash of
    the text, if that is a column of it. With few rejected rows, their number being counted, no text is shuffled. The keys have
    names of their own, so the documents may have columns of any name."""
    own = {c: f"{c}-{uuid.uuid4().hex}" for c in rejected.columns}
    keys = stored(rejected.distinct(), "rejected")
    few = keys.count() <= BROADCAST_KEYS
    keys = keys.select(*[F.col(c).alias(name) for c, name in own.items()])
    keys = F.broadcast(keys) if few else keys
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col(f"`{own['doc_id']}`"))
    if "body" in own:
        same = same & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(f"`{own['body']}`"))
    return docs.join(keys, same, "left_anti")


def release_memory() -> None:
    """Give free memory of a Python worker back to the machine. Workers serve one task after another, and what one task's
    peak has taken would otherwise stay with the worker while later stages need it."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def released(read):
    """A function on Arrow batches that gives memory back when its task ends."""

    def run(batches):
        try:
            yield from read(batches)
        finally:
            release_memory()

    return run


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Running sums of an array of numbers, in blocks, so that long arrays cost little more than their length."""
    first = F.array(F.lit(0).cast("bigint"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / block).cast("int"), F.lit(0))),
        lambda b: F.slice(lengths, b * block + 1, F.lit(block)),
    )
    inner = F.transform(
        blocks, lambda part: F.aggregate(part, first, lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x.cast("bigint"))))
    )
    based = F.aggregate(
        inner, F.struct(first.alias("base"), F.array().cast("array<bigint>").alias("sums")),
        lambda acc, part: F.struct(
            F.array(acc["base"][0] + F.element_at(part, -1)).alias("base"),
            F.concat(acc["sums"], F.transform(F.slice(part, F.lit(2), F.size(part)), lambda x: x + acc["base"][0])).alias("sums"),
        ),
    )
    return F.when(F.size(lengths) > 0, based["sums"]).otherwise(F.array().cast("array<bigint>"))
