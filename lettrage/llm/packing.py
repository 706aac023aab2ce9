"""Packing of documents into sequences: shortest-pack-first over the histogram of piece lengths.

Documents are cut into pieces of at most ``size`` ids. The histogram of piece lengths, at most ``size`` rows, is all that
reaches the driver: lengths are placed longest first, each into the packs whose filling fits and is the shortest, and only
patterns with their counts are updated. Pieces are ranked within their length; a table of rank intervals gives every
piece its sequence and offset. The ranking splits each length into parts, so a length that a third of all pieces have
isn't ranked in one task.

Where no pack has room, new ones take as many pieces of the length as fit. What a pack lacks at the end is padding.

Defined cases: null or empty text is one end id; repeated rows are packed each; equal documents of one length are ranked by
``doc_id``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettrage.llm.shared import documents, stored
from lettrage.llm.tokens import default_vocabulary, encoded

SIZE = 2048
PARTS = 64
PIECES = "doc_id bigint, start bigint, length int, ids_crc32 bigint, doc_tokens bigint"


def cut(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece."""
    path = path or default_vocabulary()

    def cut_up(batches):
        import pyarrow as pa

        rows = []
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for doc_id, ids in encoded(batches, path):
            total = len(ids) // 4
            for start in range(0, total, size):
                part = ids[4 * start : 4 * (start + size)]
                rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            if len(rows) >= 10_000:
                yield made()
                rows = []
        if rows:
            yield made()

    return documents(docs).mapInArrow(cut_up, PIECES)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns (lengths in a pack) and how many packs follow each. ``room`` holds the packs by their free space; a
    length goes to the packs with the most free space, that is the shortest ones, as far as it fits there."""
    room: dict[int, list[tuple[list[int], int]]] = {}

    def put(pattern: list[int], packs: int) -> None:
        room.setdefault(size - sum(pattern), []).append((pattern, packs))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = max((space for space in room if space >= length), default=None)
            if free is None:  # new packs: as many of this length as a pack takes, then one pack with what is left
                fits = size // length
                if left >= fits:
                    put([length] * fits, left // fits)
                if left % fits:
                    put([length] * (left % fits), 1)
                break
            pattern, packs = room[free].pop()
            if not room[free]:
                del room[free]
            used = min(packs, left)
            if packs > used:
                room.setdefault(free, []).append((pattern, packs - used))
            put([*pattern, length], used)
            left -= used
    return [entry for entries in room.values() for entry in entries]


def places(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): the ranks of a length that go to one slot of a pattern."""
    rows, used, base = [], {}, 0
    for pattern, packs in patterns:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, first + packs, base, offset))
            used[length], offset = first + packs, offset + length
        base += packs
    return rows


def ranked(pieces: DataFrame, parts: int = PARTS) -> DataFrame:
    """The pieces with their ``rank`` within their length, from 0; each length is ranked in ``parts`` parts."""
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)).cast("int"))
    counts = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")
    # At most size x parts rows.
    return parted.withColumn("own", F.row_number().over(order) - 1).join(F.broadcast(bases), ["length", "part"]).select(
        *pieces.columns, (F.col("base") + F.col("own")).alias("rank")
    )


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece."""
    pieces = stored(cut(docs, path, size), "pieces")
    spark = docs.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = places(shortest_pack_first(histogram, size))
    intervals = spark.createDataFrame(table, "length int, first bigint, until bigint, base bigint, offset bigint")
    placed = ranked(pieces).join(
        F.broadcast(intervals).withColumnRenamed("length", "of"),
        (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("until")),
    )
    return placed.select(
        "doc_id", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("base") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset",
    )
