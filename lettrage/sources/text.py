"""Scans of delimited and line-oriented text files.

Both keep the reading order: ``file_block_start`` orders the splits of a file and the row id orders
the rows inside one, however Spark packs the splits into tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fixed as fx
from .shared import stored

DELIMITERS = [";", ",", "\t", "|"]
#: Tried where none of the above fits a file; characters that names and amounts hold are left out.
RARE_DELIMITERS = list(":^~!#$*<=>?@[]`{}")
#: How far, as a share of the title line's delimiters, the lines of a file may stray from it.
STRAY = 0.75
#: A row's index is its split's start in units of ``_BLOCK_BYTES``, then its row id: in order for splits of that size or more
#: and files up to 4 TB.
_ID_BITS = 33
_BLOCK_BYTES = 1 << 12
_SHEET_ROWS = "source_path string, source_file string, source_sheet string, row_idx bigint, cells array<string>"


def _code_page() -> tuple[str, str]:
    """Control characters 0x80-0x9F and what the Windows code page means by them."""
    pairs = []
    for byte in range(0x80, 0xA0):
        try:
            pairs.append((chr(byte), bytes([byte]).decode("cp1252")))
        except UnicodeDecodeError:
            continue
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_CONTROL, _WINDOWS = _code_page()


def from_single_byte(text: Column) -> Column:
    """Text read as ISO-8859-1 with the Windows characters put in place."""
    return F.translate(text, _CONTROL, _WINDOWS)


def decoded(line: Column) -> Column:
    """A line of bytes as UTF-8, or as a single-byte code page where it is not valid UTF-8."""
    single = from_single_byte(F.decode(line.cast("binary"), "ISO-8859-1"))
    text = F.when(F.is_valid_utf8(line), line).otherwise(single)
    return F.regexp_replace(text, "^﻿", "")


def text_rows(spark: SparkSession, paths: list[str] | str, line_end: str | None = None) -> DataFrame:
    """Lines with file path, file name and ``row_ord``; they end at any line end, or at the given one."""
    return spark.read.text(paths, lineSep=line_end).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.struct(
            F.lower("_metadata.file_path").alias("file"), F.lit(0).alias("part"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"),
        ).alias("row_ord"),
        F.col("value").alias("line"),
    )


def read_feed_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """All lines of feed files; parsing keeps those that start with ``D``."""
    return text_rows(spark, paths).select("source_file", "row_ord", decoded(F.col("line")).alias("line"))


_QUOTED = '(?s)"[^"]*"'


def _number_of(char: str, text: Column) -> Column:
    """How often an ASCII character is in a text, counted in bytes: the text may be no valid UTF-8."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def _unquoted(text: Column) -> Column:
    return F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, _QUOTED, "")).otherwise(text)


def _fields(text: Column, delimiter: str) -> Column:
    """Number of fields of a record: delimiters outside quotes, and one."""
    return _number_of(delimiter, _unquoted(text)) + 1


def describe_delimited(spark: SparkSession, paths: list[str] | str, delimiters: list[str] = DELIMITERS) -> DataFrame:
    """One row per file: first line, delimiter, widest line in fields, how far the lines stray from the title line, whether
    all of it is valid UTF-8, whether a quoted value goes on over a line end, and whether it has line ends of other kinds.

    The delimiter is the one with most fields in the title line among those whose count per line strays from it by less than
    ``STRAY`` of it, or among all if there is none: the root of the mean squared difference, from one sum and one sum of
    squares per file and delimiter.
    """
    line = F.col("line")
    # read once per line, whatever number of measures it enters
    rows = text_rows(spark, paths, "\n").select("path", "source_file", "row_ord.block", "row_ord.id", "line", _unquoted(line).alias("plain"))
    rows = rows.select(
        "path", "source_file", "line", F.when(F.col("block") == 0, F.col("id")).alias("place"), F.is_valid_utf8("line").alias("valid"),
        (_number_of('"', line) % 2 == 1).alias("odd_quotes"),
        (_number_of("\r", line) > F.endswith("line", F.lit("\r")).cast("int")).alias("odd_end"), (F.trim("line", F.lit(" \r")) != "").alias("filled"),
        *[_number_of(d, F.col("plain")).alias(f"n_{i}") for i, d in enumerate(delimiters)],
    )
    found = []
    for i in range(len(delimiters)):
        n = F.when(F.col("filled"), F.col(f"n_{i}")).cast("double")
        found += [(F.max(f"n_{i}") + 1).alias(f"width_{i}"), F.sum(n).alias(f"sum_{i}"), F.sum(n * n).alias(f"squares_{i}")]
    # a collected set makes this an aggregate over objects, which a first line of text alone would have sorted all lines for
    files = rows.groupBy("path", "source_file").agg(
        F.min_by("line", "place").alias("first_line"),
        (F.size(F.collect_set(F.when(~F.col("valid"), True))) == 0).alias("utf8"), F.bool_or("odd_quotes").alias("multi"), F.bool_or("odd_end").alias("odd_end"),
        F.count_if(F.col("filled")).alias("lines"), *found,
    )

    def judged(i: int, d: str) -> Column:
        n, lines = _fields(F.col("header"), d), F.col("lines")
        h = (n - 1).cast("double")
        squares = F.col(f"squares_{i}") - 2 * h * F.col(f"sum_{i}") + lines * h * h
        stray = F.when((h > 0) & (lines > 0), F.sqrt(F.greatest(squares, F.lit(0.0)) / lines) / h).otherwise(1.0)
        return F.struct(
            (stray < STRAY).alias("steady"), n.alias("n"), F.lit(-i).alias("rank"), F.lit(d).alias("d"), F.col(f"width_{i}").alias("width"), stray.alias("stray")
        )

    judgements = [judged(i, d) for i, d in enumerate(delimiters)]
    chosen = F.greatest(*judgements) if len(judgements) > 1 else judgements[0]
    return files.withColumn("header", F.rtrim(decoded(F.col("first_line")), F.lit("\r"))).select(
        "path", "source_file", "header", "utf8", "multi", "odd_end", "lines", chosen["d"].alias("delimiter"), chosen["width"].alias("width"),
        chosen["stray"].alias("stray"),
    )


def _options(delimiter: str, width: int) -> dict:
    return {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxColumns": max(20480, width + 1)}


def _csv(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool, multi: bool, width: int, header: bool, bad: bool = False) -> DataFrame:
    schema = ", ".join([f"c{i} string" for i in range(width)] + ["bad string"] * bad)
    options = _options(delimiter, width) | {
        "header": header, "enforceSchema": True, "multiLine": multi, "encoding": "UTF-8" if utf8 else "ISO-8859-1",
    }
    if bad:
        options["columnNameOfCorruptRecord"] = "bad"
    return spark.read.options(**options).schema(schema).csv(paths)


def _widest_record(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool, width: int) -> int:
    """Fields of the widest record of files whose records go over line ends: those that don't have ``width`` fields come
    with their own text."""
    records = _csv(spark, paths, delimiter, utf8, True, width, False, bad=True)
    sized = records.select(F.struct(F.coalesce(_fields(F.col("bad"), delimiter), F.lit(0)).alias("n"), "c0").alias("record"))
    return max(width, (sized.agg(F.max("record").alias("record")).first()["record"] or {"n": 0})["n"])


# ---------------------------------------------------------------- records over line ends


class QuoteState:
    """What a line does to the state at its start: outside a quoted value (0) or inside one (1)."""

    def __init__(self, delimiter: str):
        self.delimiter, d = delimiter, re.escape(delimiter)
        field = f'(?:"(?:[^"]|"")*+"[^{d}]*+|[^"{d}][^{d}]*+|)'
        self.opened = re.compile(f'(?:{field}{d})*+"(?:[^"]|"")*+$')
        self.closing = re.compile(f'(?:[^"]|"")*+"[^{d}]*+')

    def after(self, state: int, line: str) -> int:
        if '"' not in line:
            return state
        start = 0
        if state:
            closed = self.closing.match(line)
            if not closed:
                return 1
            start = closed.end() + 1
            if start > len(line):
                return 0
        return int(self.opened.match(line[start:] if start else line) is not None)

    def effect(self, line: Column) -> Column:
        """What a line does to both states, by the same rules: 0 keeps the state, 1 turns it, 2 sets it to 0 and 3 to 1.

        All repetitions are possessive, so that a long line needs no deep stack.
        """
        d = re.escape(self.delimiter)
        quoted, rest = '(?:[^"]++|"")*+', f"[^{d}]*+"
        opened = f'(?:(?:"{quoted}"{rest}|[^"{d}]{rest}|){d})*+"{quoted}\\z'
        from0 = line.rlike("\\A" + opened)
        # a line that closes no value stays inside; one that does may open another behind a delimiter
        from1 = ~line.rlike(f'\\A{quoted}"') | line.rlike(f'\\A{quoted}"{rest}{d}{opened}')
        known = F.when(from0, F.when(from1, 3).otherwise(TURNS)).otherwise(F.when(from1, KEEPS).otherwise(2))
        return F.when(F.contains(line, F.lit('"')), known).otherwise(KEEPS)


_SPLIT = "path string, block bigint, from0 int, from1 int"
_FRAGMENT = "path string, source_file string, block bigint, place bigint, part int, text string"
WHOLE, HEAD, MIDDLE, TAIL = range(4)
KEEPS, TURNS, SETS = range(3)


def states_after(effects: np.ndarray, state: int) -> np.ndarray:
    """The quote state after each of several lines, from their effects and the state before the first: the last line that
    sets the state, and the number of turns since."""
    place = np.maximum.accumulate(np.where(effects >= SETS, np.arange(len(effects)), -1))
    turns = np.cumsum(effects == TURNS)
    is_set = place >= 0
    return np.where(is_set, effects[place] - SETS, state) ^ ((turns - np.where(is_set, turns[place], 0)) & 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The lines of a batch by split."""
    path, block = batch.column("path"), batch.column("block")
    if not batch.num_rows:
        return
    other = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1]))
    starts = [0, *(np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        yield path[a].as_py(), block[a].as_py(), batch.slice(a, b - a)


def _lines(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool = True) -> DataFrame:
    """Lines in reading order with their effect on the quote state; those of one file and block are one split, in one task."""
    line = F.col("line") if utf8 else from_single_byte(F.decode(F.col("line").cast("binary"), "ISO-8859-1"))
    rows = text_rows(spark, paths, "\n").withColumn("line", line)
    bare = F.when(F.endswith("line", F.lit("\r")), F.regexp_replace("line", "\r$", "")).otherwise(F.col("line"))
    return rows.select("path", "source_file", "row_ord.block", "line", QuoteState(delimiter).effect(bare).alias("effect"))


def inside_quotes(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool = True) -> list[tuple[str, int]]:
    """The splits (path, block) that begin inside a quoted value. Every split computes what it does to both states; one
    row per split, in order, then gives the state at its start. Lines without quotes change no state and don't leave the scan."""

    def effect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["path", "block", "from0", "from1"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        made = lambda row: pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], columns)
        split, ends = None, [0, 1]
        for batch in batches:
            for path, block, rows in _runs(batch):
                if (path, block) != split:
                    if split:
                        yield made((*split, *ends))
                    split, ends = (path, block), [0, 1]
                effects = rows.column("effect").to_numpy(zero_copy_only=False)
                ends = [int(states_after(effects, state)[-1]) for state in ends]
        if split:
            yield made((*split, *ends))

    lines = _lines(spark, paths, delimiter, utf8)
    quoted = lines.filter(F.contains("line", F.lit('"'))).select("path", "block", "effect").mapInArrow(effect, _SPLIT)
    # a split without quotes keeps the state, and begins like the next one: every block of a file needs a row
    blocks = lines.select("path", "block").distinct().join(quoted, ["path", "block"], "left")
    known = blocks.select("path", "block", F.coalesce("from0", F.lit(0)).alias("from0"), F.coalesce("from1", F.lit(1)).alias("from1"))
    # one row per split of a file, as many as the driver lists when it plans the scan; the last split that leads to one state
    # whatever it begins with, and the number of changes after it, give the state
    order = Window.partitionBy("path").orderBy("block")
    flip = F.when(F.col("from0") > F.col("from1"), 1).otherwise(0)
    counted = known.withColumn("flips", F.sum(flip).over(order))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.last(F.when(F.col("from0") == F.col("from1"), F.struct("from0", "flips")), ignorenulls=True).over(before)
    placed = counted.withColumns({"fixed": fixed, "earlier": F.coalesce(F.max("flips").over(before), F.lit(0))})
    state = (F.coalesce("fixed.from0", F.lit(0)) + F.col("earlier") - F.coalesce("fixed.flips", F.lit(0))) % 2
    inside = placed.filter(state == 1).select("path", "block")
    return [(r["path"], r["block"]) for r in inside.toLocalIterator()]


def records_over_lines(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool = True) -> DataFrame:
    """``path, source_file, block, place, text``: the records of files whose quoted values go over line ends, read in splits.
    A split puts its own lines together, whole batches at a time; what it has of a record that began or goes on in another
    split is joined by order of the splits, which only moves these pieces. The pieces are stored, as several steps read them."""
    inside = set(inside_quotes(spark, paths, delimiter, utf8))
    columns = ["path", "source_file", "block", "place", "part", "text"]

    def pieces_of(split: tuple, name: str, places, parts, texts) -> pa.RecordBatch:
        n = len(texts)
        arrays = [pa.repeat(pa.scalar(split[0]), n), pa.repeat(pa.scalar(name), n), pa.repeat(pa.scalar(split[1], pa.int64()), n)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(places, pa.int64()), pa.array(parts, pa.int32()), texts], columns)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the lines of the record at hand that came in earlier batches, the place of its first line, lines read of the split,
        # and whether the record began in an earlier split
        split, name, state, held, first, number, began = None, None, 0, [], 0, 0, False
        left = lambda: pieces_of(split, name, [first], [MIDDLE if began else TAIL], pa.array(["\n".join(held)], pa.string()))
        for batch in batches:
            for path, block, rows in _runs(batch):
                if (path, block) != split:
                    if held:
                        yield left()
                    split, name, number, first, held = (path, block), rows.column("source_file")[0].as_py(), 0, 0, []
                    began = split in inside
                    state = int(began)
                lines = rows.column("line")
                states = states_after(rows.column("effect").to_numpy(zero_copy_only=False), state)
                state = int(states[-1])
                ends = np.flatnonzero(states == 0)
                if len(ends):
                    starts = np.concatenate([[0], ends[:-1] + 1])
                    offsets = pa.array(np.concatenate([starts, ends[-1:] + 1]), pa.int32())
                    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, lines), "\n")
                    places, parts = starts + number, np.full(len(ends), WHOLE, np.int32)
                    if held:
                        texts = pa.concat_arrays([pa.array(["\n".join([*held, texts[0].as_py()])], pa.string()), texts[1:]])
                        places[0] = first
                    if began:
                        parts[0] = HEAD
                    texts = pc.utf8_rtrim(texts, characters="\r")
                    made = pieces_of(split, name, places, parts, texts)
                    # an empty line is no record
                    yield made.filter(pc.or_(pc.not_equal(texts, ""), pc.not_equal(made.column("part"), WHOLE)))
                    held, began = [], False
                    first = number + int(ends[-1]) + 1
                    held += lines[int(ends[-1]) + 1 :].to_pylist()
                else:
                    held += lines.to_pylist()
                number += rows.num_rows
        if held:
            yield left()

    pieces = stored(_lines(spark, paths, delimiter, utf8).mapInArrow(assemble, _FRAGMENT), "record-pieces")
    columns_left = ["path", "source_file", "block", "place", "text"]
    # at most two pieces per split: a record's end from the split before, and the begin of one that goes on
    order = Window.partitionBy("path").orderBy("block", "place")
    owned = pieces.filter(F.col("part") != WHOLE).withColumn("owner", F.count_if(F.col("part") == TAIL).over(order))
    joined = owned.groupBy("path", "source_file", "owner").agg(F.min(F.struct("block", "place")).alias("at"), F.sort_array(F.collect_list(F.struct("block", "place", "text"))).alias("parts"))
    joined = joined.select("path", "source_file", "at.block", "at.place", F.array_join("parts.text", "\n").alias("text"))
    return pieces.filter(F.col("part") == WHOLE).select(columns_left).unionByName(joined.select(columns_left))


def _split_records(spark: SparkSession, paths: list[str], delimiter: str, utf8: bool) -> DataFrame:
    """Sheet rows of files whose records go over line ends, as wide as the widest record, with ``title`` for the first of
    every file."""
    records = records_over_lines(spark, paths, delimiter, utf8)
    order = F.floor(F.col("block") / _BLOCK_BYTES) * (1 << _ID_BITS) + F.col("place") + 1
    rows = records.select(
        F.col("path").alias("source_path"), "source_file", F.lit("CSV").alias("source_sheet"), order.cast("bigint").alias("row_idx"), "text"
    )
    found = rows.groupBy("source_path").agg(F.min("row_idx").alias("row_idx"), F.max(_fields(F.col("text"), delimiter)).alias("width")).collect()
    width = max((r["width"] for r in found), default=1)
    record = F.from_csv("text", F.lit(", ".join(f"c{i} string" for i in range(width))), _options(delimiter, width) | {"multiLine": True})
    titles = spark.createDataFrame([(r["source_path"], r["row_idx"], True) for r in found], "source_path string, row_idx bigint, title boolean")
    # one row per file, as in the listing
    placed = rows.withColumn("record", record).join(F.broadcast(titles), ["source_path", "row_idx"], "left")
    return placed.withColumn("title", F.col("title").isNotNull()).select(
        "source_path", "source_file", "source_sheet", "row_idx", "title", *[F.col(f"record.c{i}").alias(f"c{i}") for i in range(width)]
    )


def _listed_files(spark: SparkSession, paths: list[str] | str, delimiters: list[str]) -> Iterator:
    """The description of every file. Where none of the delimiters fits a file of several lines, it is described by those
    of ``RARE_DELIMITERS`` instead, if one of them does."""
    unclear = {}
    for f in describe_delimited(spark, paths, delimiters).toLocalIterator():
        if f["stray"] >= STRAY and f["lines"] > 1 and delimiters is DELIMITERS:
            unclear[f["path"]] = f
        else:
            yield f
    if unclear:
        for f in describe_delimited(spark, list(unclear), RARE_DELIMITERS).toLocalIterator():
            yield f if f["stray"] < STRAY else unclear[f["path"]]


def read_delimited(spark: SparkSession, paths: list[str] | str, delimiters: list[str] = DELIMITERS) -> DataFrame:
    """Delimited files as sheet rows ``(source_path, source_file, source_sheet, row_idx, cells)``, all text.

    Every record becomes one row with all its cells: quotes are doubled inside quoted values, which may hold delimiters
    and line ends, and a group's rows are as wide as its widest record. Files are grouped by delimiter, encoding and
    whether records go over line ends. All are read in splits, but for files of the last kind with line ends of several kinds,
    as what a line end inside a value was can't be told from lines. Row 0 holds the titles. The paths,
    which Spark's file listing holds on the driver anyway, come there one by one; titles stay distributed.
    """
    groups: dict[tuple, list] = {}
    for f in _listed_files(spark, paths, delimiters):
        group = groups.setdefault((f["delimiter"], f["utf8"], f["multi"], f["multi"] and f["odd_end"]), [1, []])
        group[0] = max(group[0], f["width"])
        group[1].append(f["path"])
    parts = [spark.createDataFrame([], _SHEET_ROWS)]
    keys = ["source_path", "source_file", "source_sheet"]
    for (delimiter, utf8, multi, whole), (width, listed) in sorted(groups.items()):
        first = lambda c: F.regexp_replace(c, "^\ufeff", "")
        if multi and not whole:
            rows = _split_records(spark, listed, delimiter, utf8)
            columns = [c for c in rows.columns if c not in (*keys, "row_idx", "title")]
            shown = lambda c: first(F.col(c)) if c == columns[0] else F.col(c)
            cells = [F.when(F.col("title"), shown(c)).when(~F.col(c).isin(fx.CSV_MISSING), F.col(c)) for c in columns]
            parts.append(rows.select(*keys, F.when(F.col("title"), 0).otherwise(F.col("row_idx")).cast("bigint").alias("row_idx"), F.array(*cells).alias("cells")))
        else:
            if multi:
                width = _widest_record(spark, listed, delimiter, utf8, width)
            columns = [f"c{i}" for i in range(width)]
            shown = lambda c: F.col(c) if utf8 else from_single_byte(F.col(c))
            order = (
                F.floor(F.col("_metadata.file_block_start") / _BLOCK_BYTES) * (1 << _ID_BITS)
                + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ID_BITS) - 1))
                + 1
            )
            place = [F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_name").alias("source_file"), F.lit("CSV").alias("source_sheet")]
            body = _csv(spark, listed, delimiter, utf8, multi, width, True).select(
                *place, order.cast("bigint").alias("row_idx"), F.array(*[F.when(~F.col(c).isin(fx.CSV_MISSING), shown(c)) for c in columns]).alias("cells")
            )
            records = _csv(spark, listed, delimiter, utf8, multi, width, False).filter(F.col("_metadata.file_block_start") == 0)
            head = records.select(*place, order.alias("place"), F.array(*[shown(c) for c in columns]).alias("cells")).groupBy(*keys).agg(
                F.lit(0).cast("bigint").alias("row_idx"), F.min_by("cells", "place").alias("cells")
            )
            others = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
            head = head.withColumn("cells", F.concat(F.array(first(F.get("cells", F.lit(0)))), others))
            parts.append(head.unionByName(body))
    return reduce(DataFrame.unionByName, parts)


def source_inventory(
    spark: SparkSession, root: str, extensions: dict[str, list[str]], min_required: dict[str, int] | None = None
) -> DataFrame:
    """``(source_type, n_files, missing)`` per source folder under the root; file contents are not read."""
    required = min_required or {}
    wanted = spark.createDataFrame(
        [(kind, required.get(kind, 0)) for kind in extensions], "source_type string, required int"
    )
    part = lambda i: F.element_at(F.split("path", "/"), i)
    kind, suffix = part(-2), F.lower(F.concat(F.lit("."), F.element_at(F.split(part(-1), r"\."), -1)))
    allowed = F.lit(False)
    for name, listed in extensions.items():
        allowed = allowed | ((kind == name) & suffix.isin([e.lower() for e in listed]))
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select("path").filter(allowed).groupBy(kind.alias("source_type")).agg(F.count(F.lit(1)).alias("n"))
    )
    n = F.coalesce("n", F.lit(0))
    return wanted.join(files, "source_type", "left").select(
        "source_type", n.cast("bigint").alias("n_files"), F.greatest(F.col("required") - n, F.lit(0)).cast("bigint").alias("missing")
    )
