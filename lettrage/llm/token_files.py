"""Token-id files: ids in ascending document order, coded with one canonical Huffman code of the whole corpus.

1. Documents are tokenised once; their ids go to a table in the shared folder, and beside them what every task has counted
   of each id.
2. The sum of the counts, one row per id of the vocabulary, gives code lengths of at most 16 bits.
3. Documents are range-partitioned by id and sorted. Every partition codes their ids, with a bit offset every ``EVERY`` ids,
   and writes its blocks. A block ends after the document with which it reaches ``BLOCK`` ids,
   and holds the bit streams, each from a byte's begin, and ids, token counts, stream lengths and offsets of its documents.
   The code lengths are stored once beside the blocks.
4. Blocks are decoded independently by table, all runs between checkpoints of a block at once.

The files are Parquet with one row per block, so any store that Spark writes will do, and a repeated task leaves no trace.

Defined cases: null or empty text is the end id alone; rows with equal ``doc_id`` are ordered by their text's hash; a null
``doc_id`` comes first; a document longer than a block has a block of its own; an empty table gives files without blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettrage.llm import huffman
from lettrage.llm.shared import documents, shared_folder, stored
from lettrage.llm.tokens import default_vocabulary, encoded, vocabulary_size

BLOCK = 1 << 16
EVERY = 64
IDS = "doc_id bigint, tie bigint, n bigint, symbols array<bigint>, counts array<bigint>, ids binary"
#: Ids counted at a time.
COUNTED = 1 << 20
BLOCKS = (
    "shard int, block int, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, sizes array<bigint>, offsets binary, bits binary"
)
ROWS = "shard int, block int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


def batch_of(schema: str, columns):
    """A record batch of Python columns, with the names and types of the schema."""
    import pyarrow as pa

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def in_batches(rows, schema: str, most: int = 1 << 22):
    """Record batches of rows whose last column holds about ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= most or len(held) >= 5000:
            yield batch_of(schema, zip(*held))
            held, size = [], 0
    if held:
        yield batch_of(schema, zip(*held))


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, tie, n, ids`` per document, with 16-bit ids, or 32-bit ones for a larger vocabulary; and one row per task
    without ids: ``symbols``, the distinct ids of the task, and their ``counts``."""
    size = vocabulary_size(path)
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def read(batches):
        def rows():
            total, held, waiting = np.zeros(size, dtype=np.int64), [], 0
            for doc_id, tie, raw in encoded(batches, path):
                ids = np.frombuffer(raw, dtype="<u4").astype(kind)
                held.append(ids)
                waiting += len(ids)
                if waiting >= COUNTED:
                    total += np.bincount(np.concatenate(held), minlength=size)
                    held, waiting = [], 0
                yield doc_id, tie, len(ids), None, None, ids.tobytes()
            if held:
                total += np.bincount(np.concatenate(held), minlength=size)
            found = np.flatnonzero(total)
            yield None, None, 0, found, total[found], None

        yield from in_batches(rows(), IDS)

    return documents(docs).withColumn("tie", F.xxhash64("text")).mapInArrow(read, IDS)


def unpacked(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4")


def id_counts(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in the whole corpus: one sum per id of the vocabulary."""
    pairs = tokens.filter(F.col("ids").isNull()).select(F.inline(F.arrays_zip("symbols", "counts")))
    rows = pairs.groupBy("symbols").agg(F.sum("counts").alias("n")).collect()
    counts = np.zeros(size, dtype=np.int64)
    for r in rows:
        counts[r["symbols"]] = r["n"]
    return counts


def write(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Code the documents into ``folder``/blocks, and the code lengths into ``folder``/code."""
    path = path or default_vocabulary()
    spark = docs.sparkSession
    tokens = stored(tokenised(docs, path), "token-ids", "zstd")
    lengths = huffman.code_lengths(id_counts(tokens, vocabulary_size(path)))
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(f"{folder}/code")

    def assemble(batches):
        from pyspark import TaskContext

        code = huffman.Code.canonical(lengths)

        def rows():
            shard, number, held, total = TaskContext.get().partitionId(), 0, [], 0
            for batch in batches:
                for doc_id, n, ids in zip(*[c.to_pylist() for c in batch.columns]):
                    bits, offsets = code.encode(unpacked(ids, n), EVERY)
                    held.append((doc_id, n, offsets.astype("<u4").tobytes(), bits))
                    total += n
                    if total >= BLOCK:
                        yield block(shard, number, total, held)
                        number, held, total = number + 1, [], 0
            if held:
                yield block(shard, number, total, held)

        def block(shard, number, total, held):
            doc_ids, counts, offsets, bits = zip(*held)
            return shard, number, total, list(doc_ids), list(counts), [len(b) for b in bits], b"".join(offsets), b"".join(bits)

        yield from in_batches(rows(), BLOCKS)

    # dealt out before coding: the bounds of ranges are sampled from rows, which are read for it, but not coded twice
    ids = tokens.filter(F.col("ids").isNotNull()).select("doc_id", "tie", "n", "ids")
    ordered = ids.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "n", "ids").mapInArrow(assemble, BLOCKS).write.parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files."""
    lengths = np.frombuffer(spark.read.schema("lengths binary").parquet(f"{folder}/code").first()["lengths"], dtype=np.uint8)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")

    def decode(batches):
        code = huffman.Code.canonical(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                shard, number, _, doc_ids, counts, sizes, offsets, bits = (c[row].as_py() for c in batch.columns)
                ids = code.decode(bits, np.frombuffer(offsets, dtype="<u4"), np.array(sizes), np.array(counts), EVERY).astype("<u4")
                ends = np.cumsum(counts)
                sums = [zlib.crc32(ids[e - c : e].tobytes()) for c, e in zip(counts, ends.tolist())]
                size = len(counts)
                yield batch_of(ROWS, ([shard] * size, [number] * size, doc_ids, ends - counts, counts, sums))

    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.select("shard", "block", "n_tokens")
    # One row per shard, that is per partition of the write: bounded by the job, not by the data in it.
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    shards = shards.select("shard", F.coalesce(
        F.sum("held").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("shard_base"))
    bases = sizes.withColumn("block_base", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(shards, "shard")
    rows = blocks.mapInArrow(decode, ROWS)
    return rows.join(bases.select("shard", "block", (F.col("shard_base") + F.col("block_base")).alias("base")), ["shard", "block"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    folder = shared_folder(docs.sparkSession, "token-files")
    write(docs, folder, path)
    return read(docs.sparkSession, folder)
