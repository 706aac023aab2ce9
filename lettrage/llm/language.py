"""Language identification by n-gram filters that answer for all languages at once.

Fitting counts the four-byte windows of lower-cased UTF-8 text per language on a sample of at most ``SAMPLE`` labelled rows
per language, in expectation, and keeps the windows typical of each language. They go into a bit-sliced Bloom filter: slot h holds
one bit per language, and the AND of ``HASHES`` slots is the set of languages that contain a window. Prediction looks up
every window of the whole text, counts the bits per language, takes off the false positives that the language's share
of set bits lets expect, and names the language with the most windows left.

Defined cases: null text or text without a letter is ``und`` with score 0; the label, the source and the id are never
read in prediction; ties go to the language first in alphabetical order; text in which no window is known gets the
language with the most labelled rows and score 0; without labelled rows every document is ``und``; rows without a label
or text are not learned from; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettrage.llm.shared import released

UNKNOWN = "und"
SAMPLE = 5_000
TYPICAL = 30_000
RATIO = 0.2
LEAST = 3
SLOTS = 1 << 20
HASHES = 3
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
GAP = b"    "
#: Bytes looked up at once.
CHUNK = 1 << 21


@dataclass
class Filters:
    """``slots``: bits of all languages per slot; ``rates``: expected false positives per language."""

    languages: list[str]
    slots: np.ndarray
    rates: np.ndarray
    fallback: int

    @classmethod
    def build(cls, windows: dict[str, np.ndarray], rows: dict[str, int]) -> Filters:
        languages = sorted(windows)
        kind = np.uint64 if len(languages) > 32 else np.uint32 if len(languages) > 8 else np.uint8
        slots = np.zeros((SLOTS, max(1, -(-len(languages) // 64))), dtype=kind)
        for i, name in enumerate(languages):
            for places in hashes(windows[name]):
                slots[places, i // 64] |= kind(1 << (i % 64))
        filled = [np.count_nonzero(slots[:, i // 64] >> kind(i % 64) & kind(1)) / SLOTS for i in range(len(languages))]
        most = max(range(len(languages)), key=lambda i: (rows[languages[i]], -i), default=0)
        return cls(languages, slots, np.array(filled) ** HASHES, most)

    def count(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Windows per text, and per text and language the windows found, corrected for false positives."""
        keys, starts, sizes = windows_of(texts)
        masks = None
        for places in hashes(keys):
            got = self.slots[places]
            masks = got if masks is None else masks & got
        found = np.empty((len(texts), len(self.languages)))
        kind = self.slots.dtype.type
        for i in range(len(self.languages)):
            bits = (masks[:, i // 64] >> kind(i % 64) & kind(1)).astype(np.int64)
            found[:, i] = np.add.reduceat(bits, starts)
        corrected = (found - sizes[:, None] * self.rates) / (1 - self.rates)
        return sizes, np.maximum(corrected, 0)


def hashes(keys: np.ndarray):
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    mixed = keys ^ (keys >> np.uint32(15))
    for m in MULTIPLIERS[:HASHES]:
        yield ((mixed * np.uint32(m)) >> shift).astype(np.intp)


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of all texts one after another, where each text's begin, and how many it has: those that begin at
    one of its bytes, or at a space before them; spaces follow its end, so no window reaches the next text."""
    joined = np.frombuffer(b"".join(b" " + t + GAP for t in texts), dtype=np.uint8).astype(np.uint32)
    keys = joined[:-3] | joined[1:-2] << 8 | joined[2:-1] << 16 | joined[3:] << 24
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + len(GAP))[:-1]])
    keep = np.repeat(np.tile([True, False], len(texts)), np.stack([sizes, np.full(len(texts), len(GAP))], 1).ravel())[: len(keys)]
    return keys[keep], np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes


def chunks(batches, *columns: str):
    """Lists of rows whose texts (first column, bytes) hold about ``CHUNK`` bytes; a longer text comes alone."""
    rows, held = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for row in zip(*[part.column(batch.schema.get_field_index(c)).to_pylist() for c in columns]):
                if rows and held + len(row[0] or b"") > CHUNK:
                    yield rows
                    rows, held = [], 0
                rows.append(row)
                held += len(row[0] or b"")
    if rows:
        yield rows


def lowered(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(F.encode(F.lower("text"), "utf-8").alias("lowered"), *columns)


def fit(docs: DataFrame, label: str = "lang", sample: int = SAMPLE) -> Filters:
    """Filters from the rows of ``docs`` that have text and label. What reaches the driver is bounded by the number of
    languages times ``TYPICAL``."""
    labelled = docs.filter(F.col("text").isNotNull() & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", F.col(label).alias("label"))
    rows = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return Filters([], np.zeros((SLOTS, 1), dtype=np.uint8), np.zeros(0), 0)
    share = F.lit(1.0)
    for name, n in sorted(rows.items()):
        share = F.when(F.col("label") == name, sample / n).otherwise(share)
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000)

    def count(batches):
        import pyarrow as pa

        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for part in chunks(batches, "lowered", "label"):
            for name in {r[1] for r in part}:
                keys, _, _ = windows_of([r[0] for r in part if r[1] == name])
                got, n = np.unique(keys, return_counts=True)
                if name in total:
                    got, at = np.unique(np.concatenate([total[name][0], got]), return_inverse=True)
                    n = np.bincount(at, np.concatenate([total[name][1], n])).astype(np.int64)
                total[name] = got, n
        for name, (got, n) in sorted(total.items()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(got)), pa.array(got.astype(np.int64)), pa.array(n.astype(np.int64))], ["label", "w", "n"]
            )

    counted = lowered(chosen, "label").mapInArrow(released(count), "label string, w bigint, n bigint").groupBy("label", "w").agg(F.sum("n").alias("n"))
    sizes = counted.groupBy("label").agg(F.sum("n").alias("size"))
    shares = counted.filter(F.col("n") >= LEAST).join(F.broadcast(sizes), "label").withColumn("share", F.col("n") / F.col("size"))
    typical = shares.withColumn("most", F.max("share").over(Window.partitionBy("w"))).filter(F.col("share") >= RATIO * F.col("most"))
    order = Window.partitionBy("label").orderBy(F.desc("share"), "w")
    kept = typical.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= TYPICAL).select("label", "w").toPandas()
    windows = {name: kept.loc[kept["label"] == name, "w"].to_numpy().astype(np.uint32) for name in rows}
    return Filters.build(windows, rows)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, body, lang_pred, score, known``: ``body`` is the text's hash, ``score`` is the language's share of the corrected counts of all languages,
    ``known`` the share of the text's windows that the language's filter holds, corrected."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(batches):
        import pyarrow as pa

        model = shared.value
        for part in chunks(batches, "lowered", "doc_id", "lettered", "body"):
            if model.languages:
                sizes, counts = model.count([r[0] or b"" for r in part])
            else:
                sizes, counts = np.ones(len(part)), np.zeros((len(part), 1))
            best, whole = counts.argmax(1), counts.sum(1)
            top = counts[np.arange(len(part)), best]
            names, scores = [], np.where(whole > 0, top / np.maximum(whole, 1e-300), 0.0)
            for row, at, total in zip(part, best, whole):
                lettered = row[2] and model.languages
                names.append(model.languages[at if total > 0 else model.fallback] if lettered else UNKNOWN)
            lost = np.array([n == UNKNOWN for n in names])
            yield pa.RecordBatch.from_arrays([
                pa.array([r[1] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.int64()), pa.array(names, pa.string()), pa.array(np.where(lost, 0.0, scores)),
                pa.array(np.where(lost, 0.0, np.minimum(top / np.maximum(sizes, 1), 1.0))),
            ], ["doc_id", "body", "lang_pred", "score", "known"])

    texts = lowered(
        docs, F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"),
    )
    return texts.mapInArrow(released(judge), "doc_id bigint, body bigint, lang_pred string, score double, known double")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
