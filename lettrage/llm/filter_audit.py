"""Audit of how text filters interact: what each removes, alone and in every order.

Five filters fail a document: A, under 100 words; B, few distinct words; C, many capitals; D, marks of junk; E, the text
of a smaller ``doc_id``. Whether E fails is found with radix tries. Every task inserts its texts, whole, into a compressed
trie that holds the least id at each terminal; documents that lose against a smaller id of their own task are decided
there, so of a text that fills a third of all rows one row per task and trie is left. What is left is range-partitioned by
text prefixes, which are made longer where many texts begin alike, and inserted into one trie per partition. The terminals
give the flags. The documents' failures then meet the labels as masks without text, and are counted by part, mask and label;
all orders are derived from these counts.

Defined cases: null text is empty, null language the empty part; words are separated by blanks, ``[\\x20\\x09-\\x0D]+``;
an empty text fails A alone, and E where a smaller id has none either. Rows that share ``doc_id`` and text count as often as
they occur and are no copies of each other. A row without ``doc_id`` never fails E, makes no other fail and has no label.
Of several labels of one document any 1 counts. An empty table gives no rows. Other columns are left behind.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import documents, stored

FILTERS = "ABCDE"
COPY = 16
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
JUNK, CAPITALS, CONTINUED = b"#$%&*|", bytes(range(65, 91)), bytes(range(128, 192))
#: Bytes of text in the trie of a map task before it is emptied, and of a partition. Sampled texts per partition, and the
#: first length of prefixes: these choose the bounds of partitions and have no effect on results.
TASK_BYTES, PART_BYTES = 16 << 20, 128 << 20
SAMPLED, DEPTH = 64, 16
SENT = "bucket int, text binary, doc_id bigint, part string, mask int, n bigint"
FLAGS = "doc_id bigint, part string, mask int, n bigint"


def content_mask(raw: bytes) -> int:
    """Bits 1, 2, 4, 8 for the failures A to D of a UTF-8 text."""
    words = raw.split()
    count = len(words)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    points = len(raw.translate(None, CONTINUED))
    junk = len(raw.translate(None, JUNK)) < len(raw)
    return (
        (count < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * count) << 1 | (100 * capitals > MOST_CAPITALS * points) << 2 | junk << 3
    )


class Node:
    __slots__ = ("edges", "held")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.held: tuple[int, int, dict[str, int]] | None = None


def shared_length(label: bytes, text: bytes, at: int) -> int:
    """How many bytes ``label`` and ``text`` from ``at`` have in common, by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie of texts. A terminal holds the least id of its text, the text's mask, and how many rows of that id
    there are in each part. ``bytes`` is the length of all distinct texts."""

    def __init__(self):
        self.root, self.bytes = Node(), 0

    def terminal(self, text: bytes) -> Node:
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node()
                node.edges[text[at]] = text[at:], leaf
                return leaf
            label, child = edge
            if not text.startswith(label, at):
                cut = shared_length(label, text, at)
                fork = Node()
                fork.edges[label[cut]] = label[cut:], child
                label, child = label[:cut], fork
                node.edges[text[at]] = label, child
            node, at = child, at + len(label)
        return node

    def insert(self, text: bytes, doc_id: int, mask: int, part: str, n: int) -> list[tuple]:
        """The rows (doc_id, part, mask, n) that this row decides: itself, or those of the id that was least before."""
        node = self.terminal(text)
        if node.held is None:
            node.held = doc_id, mask, {part: n}
            self.bytes += len(text)
            return []
        least, _, parts = node.held
        if doc_id > least:
            return [(doc_id, part, mask | COPY, n)]
        if doc_id == least:
            parts[part] = parts.get(part, 0) + n
            return []
        node.held = doc_id, mask, {part: n}
        return [(least, p, mask | COPY, held) for p, held in parts.items()]

    def walk(self) -> Iterator[tuple[bytes, int, int, dict[str, int]]]:
        """(text, least id, mask, parts) of the terminals in the order of their texts."""
        stack = [(b"", b"", self.root)]
        while stack:
            before, label, node = stack.pop()
            text = before + label
            if node.held is not None:
                yield text, *node.held
            for first in sorted(node.edges, reverse=True):
                stack.append((text, *node.edges[first]))


def packets(rows: Iterator[tuple], schema: pa.Schema, text_at: int | None, rows_most: int = 10_000, bytes_most: int = 8 << 20):
    """Rows as record batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at] or b"") if text_at is not None else 0
        if len(held) >= rows_most or size >= bytes_most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


SENT_ARROW = pa.schema([("bucket", pa.int32()), ("text", pa.binary()), ("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])
FLAGS_ARROW = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())])


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[list[list]]:
    """The columns of a batch as lists, few rows at a time; texts come as bytes."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield [(c.cast(pa.binary()) if pa.types.is_string(c.type) else c).to_pylist() for c in part.columns]


def within_tasks(cuts: list[bytes], parts: int):
    """(doc_id, text, part) -> rows of ``SENT``: decided ones without text, and one of each text of a trie."""

    def rows(batches) -> Iterator[tuple]:
        trie = Trie()
        spill = lambda: (
            (bisect_right(cuts, text), text, least, part, mask, n) for text, least, mask, held in trie.walk() for part, n in held.items()
        )
        for batch in batches:
            for ids, texts, langs in slices(batch):
                for doc_id, text, lang in zip(ids, texts, langs):
                    mask, part = content_mask(text), lang.decode()
                    decided = [(None, part, mask, 1)] if doc_id is None else trie.insert(text, doc_id, mask, part, 1)
                    for row in decided:
                        yield (row[0] or 0) % parts, None, *row
                if trie.bytes >= TASK_BYTES:
                    yield from spill()
                    trie = Trie()
        yield from spill()

    return lambda batches: packets(rows(batches), SENT_ARROW, 1)


def across_tasks(batches):
    """Rows of ``SENT`` of one partition -> rows of ``FLAGS``."""

    def rows() -> Iterator[tuple]:
        trie = Trie()
        for batch in batches:
            for _, texts, ids, parts, masks, counts in slices(batch):
                for text, doc_id, part, mask, n in zip(texts, ids, parts, masks, counts):
                    part = part.decode()
                    if text is None:
                        yield doc_id, part, mask, n
                    else:
                        yield from trie.insert(text, doc_id, mask, part, n)
        for _, least, mask, held in trie.walk():
            for part, n in held.items():
                yield least, part, mask, n

    return packets(rows(), FLAGS_ARROW, None)


def prefix_cuts(docs: DataFrame, parts: int, rows: int) -> list[bytes]:
    """At most ``parts - 1`` prefixes that cut the distinct texts into ranges of like size, from a sample of some ``SAMPLED``
    texts a range. A prefix that begins more than a range's share of the sample is made four times as long, until it isn't
    heavy or is a whole text."""
    if parts < 2:
        return []
    sample = stored(docs.sample(min(1.0, SAMPLED * parts / rows), 11).select("text").distinct(), "audit-sample")
    weight = F.sum(F.octet_length("text") + 1).alias("weight")
    whole = sample.agg(weight).first()["weight"] or 0
    share, depth, weights = whole / parts, DEPTH, {}
    spark, open_texts = docs.sparkSession, sample
    while True:
        found = open_texts.groupBy(F.left("text", F.lit(depth)).alias("prefix")).agg(weight, F.max(F.length("text")).alias("longest")).collect()
        weights.update({r["prefix"]: r["weight"] for r in found})
        heavy = [(r["prefix"],) for r in found if r["weight"] > share and r["longest"] > depth]
        if not heavy:
            break
        for (prefix,) in heavy:
            del weights[prefix]
        longer = F.broadcast(spark.createDataFrame(heavy, "heavy string"))  # fewer than there are parts
        open_texts = sample.join(longer, F.left("text", F.lit(depth)) == F.col("heavy"), "left_semi")
        depth *= 4
    cuts, met = [], 0
    for prefix, size in sorted((p.encode(), w) for p, w in weights.items()):
        if met >= share * (len(cuts) + 1) and prefix:
            cuts.append(prefix)
        met += size
    return cuts[: parts - 1]


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, mask, n``: the failures of all documents as bits, A least, of ``n`` like rows."""
    spark = docs.sparkSession
    rows = documents(docs).select("doc_id", "text").withColumn("part", F.lit(""))
    if "lang" in docs.columns:
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
        )
    size = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // PART_BYTES))
    cuts = prefix_cuts(rows, min(parts, max(size["rows"], 1)), size["rows"])
    sent = rows.mapInArrow(within_tasks(cuts, parts), SENT)
    return sent.repartitionById(parts, F.col("bucket")).mapInArrow(across_tasks, FLAGS)


def letters_mask(letters: Column) -> Column:
    """The bits of a string of filter letters."""
    bits = F.transform(F.filter(F.split(letters, ""), lambda c: c != ""), lambda c: F.pow(F.lit(2), F.ascii(c) - 65).cast("int"))
    return F.aggregate(bits, F.lit(0), lambda mask, bit: mask + bit)


def audit(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step. ``kept`` and ``removed`` are documents after and at the step,
    ``redundant`` those that fail its filter and went before, ``unique_fails`` those that fail it alone, ``good_lost`` and
    ``toxic_lost`` those removed with the label, ``shapley`` what its filter removes, summed over all orders."""
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("of")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = flags.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    one = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    cells = rows.join(marks, F.col("doc_id") == F.col("of"), "left").groupBy("part", "mask", one("good"), one("toxic")).agg(F.sum("n").alias("n"))
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    placed = steps.select(
        "part", "filter_order", "step", "mask", "good", "toxic", "n",
        F.substring("filter_order", F.col("step"), F.lit(1)).alias("letter"), F.left("filter_order", F.col("step") - 1).alias("before"),
    ).withColumn("bit", letters_mask(F.col("letter"))).withColumn("earlier", letters_mask(F.col("before")))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("earlier")) > 0
    total = lambda test, name: F.sum(F.when(test, F.col("n")).otherwise(0)).cast("bigint").alias(name)
    report = placed.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~gone, "kept"), total(fails & ~gone, "removed"), total(fails & gone, "redundant"), total(F.col("mask") == F.col("bit"), "unique_fails"),
        total(fails & ~gone & (F.col("good") == 1), "good_lost"), total(fails & ~gone & (F.col("toxic") == 1), "toxic_lost"),
    )
    shares = report.groupBy(F.col("part").alias("of_part"), F.col("letter").alias("of_letter")).agg(F.sum("removed").alias("shapley"))
    return report.join(shares, (F.col("part") == F.col("of_part")) & (F.col("letter") == F.col("of_letter"))).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
