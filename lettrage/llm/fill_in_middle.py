"""Fill-in-middle transformation by displacement scatter.

A task takes the bytes of a batch of texts as one array. A scan finds the token ends and so the two cuts of each document;
every byte of a prefix, middle or suffix moves by the same distance. A difference array holds the change of that distance at
the start of each piece, its cumulative sum is the shift of every byte, and one scatter per window of bytes builds all
outputs. Restoring scans the outputs for their three marks and gathers the bytes back with the inverse shifts.

A document is ``plain`` if it is empty, holds a mark, or its hash says so; otherwise ``spm`` or ``psm``, which name the order
of its pieces. Cuts stand after whole tokens, and no piece can complete a mark, so the three marks of an output are unique.

Defined cases: null text is empty, and plain; a null ``doc_id`` is hashed as no digits; equal ids are cut alike in equal
texts; repeated rows come as often as they occur; very long texts go through windows of bounded size; an empty table gives
no rows; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import documents

SEED = 42
#: Percent of documents that are transformed, and of these percent in the order suffix, prefix, middle.
RATE, SPM_RATE = 50, 80
FORMS = ("plain", "spm", "psm")
#: Bytes of text taken together, and bytes shifted at a time.
TOGETHER, WINDOW = 4 << 20, 1 << 20
MARK = np.frombuffer(b"<P><S><M>", np.uint8).reshape(3, 3)
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
TRANSFORMED = "doc_id bigint, form string, n bigint, prefix_chars bigint, middle_chars bigint, output string"


def moved(source: np.ndarray, starts: np.ndarray, shifts: np.ndarray, size: int, gather: bool) -> np.ndarray:
    """``size`` bytes. Scatter: byte i of ``source`` goes to i + shift; gather: byte i of the result comes from i + shift.
    ``starts`` (ascending) are where pieces begin, ``shifts`` the shift of each."""
    result = np.zeros(size, np.uint8)
    changes = np.diff(shifts, prepend=0)
    length, shift = (size if gather else len(source)), 0
    for a in range(0, length, WINDOW):
        b = min(a + WINDOW, length)
        low, high = np.searchsorted(starts, [a, b])
        steps = np.zeros(b - a, np.int64)
        np.add.at(steps, starts[low:high] - a, changes[low:high])
        steps[0] += shift
        np.cumsum(steps, out=steps)
        shift = steps[-1]
        steps += np.arange(a, b)
        if gather:
            result[a:b] = source[steps]
        else:
            result[steps] = source[a:b]
    return result


def marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where marks begin in ``data``, and which of the three each is."""
    at = np.flatnonzero(data[:-2] == MARK[0, 0]) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[data[at + 2] == MARK[0, 2]]
    which = np.select([data[at + 1] == m for m in MARK[:, 1]], [0, 1, 2], 3)
    return at[which < 3], which[which < 3]


def cut(data: np.ndarray, bounds: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``n``, the number of tokens, and the ends of prefix and middle of every document, whose bytes ``bounds`` delimit."""
    blank = BLANK[data]
    last = np.ones(len(data), bool)
    last[:-1] = blank[1:]
    last[bounds[1:-1][(bounds[1:-1] > 0)] - 1] = True
    ends = np.flatnonzero(~blank & last) + 1
    begin, end = bounds[:-1], bounds[1:]
    before = np.searchsorted(ends, begin, "right")
    words = np.searchsorted(ends, end, "right") - before
    n = words.copy()
    full = end > begin
    n[full] += blank[end[full] - 1]
    a, b = first % (n + 1), second % (n + 1)

    def place(k: np.ndarray) -> np.ndarray:
        at = np.where(k == 0, begin, end)
        inner = (k > 0) & (k <= words)
        at[inner] = ends[(before + k - 1)[inner]]
        return at

    return n, place(np.minimum(a, b)), place(np.maximum(a, b))


def build(data: np.ndarray, bounds: np.ndarray, h: list[np.ndarray], rate: int, spm_rate: int):
    """Form, token count, code points of prefix and middle, output bytes and their bounds, of one batch of documents."""
    begin, end = bounds[:-1], bounds[1:]
    n, one, two = cut(data, bounds, h[0], h[1])
    at, _ = marks(data)
    owner = np.searchsorted(bounds, at, "right") - 1
    marked = np.zeros(len(begin), bool)
    marked[owner[at + 3 <= end[owner]]] = True
    form = np.where((begin == end) | marked | (h[2] % 100 >= rate), 0, np.where(h[3] % 100 < spm_rate, 1, 2))
    changed = form > 0
    sizes = end - begin + np.where(changed, MARK.size, 0)
    out = np.concatenate([[0], np.cumsum(sizes)])
    head, body, tail = one - begin, two - one, end - two
    # where the pieces go: plain as they are; spm: S suffix P prefix M middle; psm: P prefix S suffix M middle
    to_head = out[:-1] + np.select([form == 1, form == 2], [6 + tail, 3], 0)
    to_body = out[:-1] + np.where(changed, 9 + tail + head, head)
    to_tail = out[:-1] + np.select([form == 1, form == 2], [3, 6 + head], head + body)
    starts = np.stack([begin, one, two], 1).ravel()
    shifts = (np.stack([to_head, to_body, to_tail], 1) - np.stack([begin, one, two], 1)).ravel()
    output = moved(data, starts, shifts, int(out[-1]), False)
    for mark, to in zip(MARK, (to_head, to_tail, to_body)):
        for i in range(3):
            output[to[changed] - 3 + i] = mark[i]
    leading = np.append((data & 0xC0) != 0x80, False)
    points = np.add.reduceat(leading, starts, dtype=np.int64).reshape(-1, 3)
    return form, n, np.where(head > 0, points[:, 0], 0), np.where(body > 0, points[:, 1], 0), output, out


def rebuild(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the source texts and their bounds, from outputs and forms."""
    begin, end = bounds[:-1], bounds[1:]
    at, which = marks(data)
    owner = np.searchsorted(bounds, at, "right") - 1
    mine = (form[owner] > 0) & (at + 3 <= end[owner])
    places = np.zeros((len(begin), 3), np.int64)
    places[owner[mine], which[mine]] = at[mine] + 3
    changed = form > 0
    p, s, m = places.T
    head = np.where(form == 1, m - 3 - p, np.where(form == 2, s - 3 - p, end - begin))
    tail = np.where(form == 1, p - 3 - s, np.where(form == 2, m - 3 - s, 0))
    body = np.where(changed, end - m, 0)
    back = np.concatenate([[0], np.cumsum(head + body + tail)])
    one, two = back[:-1] + head, back[:-1] + head + body
    starts = np.stack([back[:-1], one, two], 1)
    sources = np.stack([np.where(changed, p, begin), np.where(changed, m, end), np.where(changed, s, end)], 1)
    return moved(data, starts.ravel(), (sources - starts).ravel(), int(back[-1]), True), back


def groups(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with some ``TOGETHER`` bytes in a text column, the bytes, and the documents' bounds in them."""
    texts = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + TOGETHER, "right")) - 1)
        yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def as_strings(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(bounds.astype(np.int64).tobytes())
    whole = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(data)])
    return whole.cast(pa.binary()).cast(pa.string())


def to_fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``doc_id, form, n, prefix_chars, middle_chars, output`` of every document; characters are null if plain."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    group = lambda i: F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i}")
    hashed = documents(docs).withColumn("digest", digest).select("doc_id", "text", *[group(i) for i in range(4)])

    def transform(batches):
        for batch in batches:
            for part, data, bounds in groups(batch, 1):
                h = [part.column(2 + i).to_numpy(zero_copy_only=False) for i in range(4)]
                form, n, head, body, output, out = build(data, bounds, h, rate, spm_rate)
                plain = form == 0
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.array(FORMS, dtype=object)[form], pa.string()), pa.array(n, pa.int64()), pa.array(head, pa.int64(), mask=plain),
                    pa.array(body, pa.int64(), mask=plain), as_strings(output, out),
                ], names=["doc_id", "form", "n", "prefix_chars", "middle_chars", "output"])

    return hashed.mapInArrow(transform, TRANSFORMED)


def restored(transformed: DataFrame) -> DataFrame:
    """The transformed documents with ``restored``, their source texts, rebuilt from ``output`` and ``form``."""
    rows = transformed.select("doc_id", "form", "n", "prefix_chars", "middle_chars", "output")

    def restore(batches):
        for batch in batches:
            for part, data, bounds in groups(batch, 5):
                names = part.column(1).to_numpy(zero_copy_only=False)
                form = np.select([names == f for f in FORMS[1:]], [1, 2], 0)
                yield pa.RecordBatch.from_arrays([*part.columns, as_strings(*rebuild(data, bounds, form))], names=[*part.schema.names, "restored"])

    return rows.mapInArrow(restore, TRANSFORMED + ", restored string")
