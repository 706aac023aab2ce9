"""Line deduplication that returns keep bitmaps instead of text.

Lines travel as 128-bit hashes of their keys with document and position. The hashes are range-partitioned and sorted by
document and position within each partition; one pass over the sorted lines meets the first document of each key and
marks the lines of all later ones. Keys that hold more than one in ``HOT_SHARE`` of all lines would fill a partition;
there are at most ``HOT_SHARE`` of them, their first documents come from a pre-aggregated count, and they are broadcast.

The result per document is a run-length bitmap: the runs (start, length) of the lines that stay.

Defined cases: null or empty text is one empty line; keys under ``min_chars`` are kept; a line repeated inside the
smallest document that holds it stays; rows with a null ``doc_id`` keep all lines and make none go; rows that share a
``doc_id`` are one document, each with its own bitmap; an empty table gives no rows; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettrage.llm.shared import stored

MIN_CHARS = 10
HOT_SHARE = 512
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case; the built-in ``lower`` serves lines of plain ASCII."""
    bare = F.trim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``k1 k2`` (128 bits of the key), ``doc``, ``body`` (which of the rows of one id), ``pos`` and ``n``, the number of lines."""
    split = docs.filter(F.col("doc_id").isNotNull() & (F.length("text") >= min_chars)).select(
        F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64("text").alias("body"), F.split("text", "\n", -1).alias("lines")
    )
    lines = split.select("doc", "body", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line"))
    keyed = lines.select("doc", "body", "n", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select(
        F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("second"), "key").alias("k2"), "doc", "body", "pos", "n"
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, hot_share: int = HOT_SHARE) -> DataFrame:
    """``doc_id, body, n_lines, n_dropped, keep`` of the rows that lose a line; all other rows keep every line.
    ``keep`` is an array of (start, length), ``body`` the hash of the row's text."""
    lines = stored(hashed_lines(docs, min_chars), "lines")
    total = lines.count()
    hot = (
        lines.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("held"), F.min("doc").alias("first"))
        .filter(F.col("held") * hot_share >= total).select("k1", "k2", "first")
    )
    hot = stored(hot, "hot-lines")
    cold = lines.join(F.broadcast(hot), ["k1", "k2"], "left_anti")
    order = Window.partitionBy("k1", "k2").orderBy("doc", "pos", "body")
    streamed = cold.repartitionByRange("k1").withColumn("first", F.first("doc").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    known = lines.join(F.broadcast(hot), ["k1", "k2"])
    columns = ["doc", "body", "pos", "n"]
    dropped = streamed.filter("doc <> first").select(columns).unionByName(known.filter("doc <> first").select(columns))
    gone = dropped.groupBy("doc", "body").agg(F.max("n").alias("n"), F.sort_array(F.collect_set("pos")).alias("gone"))
    edges = gone.select(
        "doc", "body", "n", F.size("gone").alias("n_dropped"),
        F.concat(F.array(F.lit(-1)), F.col("gone"), F.array("n")).alias("edge"),
    )
    runs = F.transform(
        F.sequence(F.lit(0), F.size("edge") - 2),
        lambda i: F.struct((F.col("edge")[i] + 1).alias("start"), (F.col("edge")[i + 1] - F.col("edge")[i] - 1).alias("length")),
    )
    return edges.select(
        F.col("doc").alias("doc_id"), "body", F.col("n").cast("bigint").alias("n_lines"), F.col("n_dropped").cast("bigint"),
        F.filter(runs, lambda r: r["length"] > 0).alias("keep"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``row``, the document's own columns as a struct, ``n_lines``, ``n_dropped`` and ``kept_text``, the lines that stay."""
    marks = bitmaps.select(F.col("doc_id").alias("of"), F.col("body").alias("of_body"), F.col("n_dropped").alias("gone"), "keep")
    rows = docs.select(
        F.struct(F.col("*")).alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("whole")
    ).withColumn("hash", F.xxhash64("whole"))
    joined = rows.join(marks, (F.col("id") == F.col("of")) & (F.col("hash") == F.col("of_body")), "left")
    lined = joined.select("row", "whole", "gone", "keep", F.split("whole", "\n", -1).alias("lines"))
    runs = F.transform("keep", lambda r: F.array_join(F.slice(F.col("lines"), r["start"] + 1, r["length"]), "\n"))
    return lined.select(
        "row", F.size("lines").cast("bigint").alias("n_lines"), F.coalesce("gone", F.lit(0).cast("bigint")).alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("whole")).otherwise(F.array_join(runs, "\n")).alias("kept_text"),
    )
