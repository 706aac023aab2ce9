"""Exact Jaccard self-join on word shingles, with set relations used to skip work.

1. Every text becomes a set of hashed shingles with a fingerprint; equal sets are linked through the least ``doc_id``.
2. Shingles are ordered by how often they repeat, rare ones first, as a table of ``SLOTS`` bytes knows it: each repeated
   shingle adds to the slot of its hash, and slots hold the logarithm. Any fixed order is exact, also where shingles share a
   slot; this one keeps the lists short, however many shingles repeat. Two sets that link share a shingle among the first n - ceil(tn) + 1 of each.
3. Those prefixes, dealt by shingle, are the inverted lists; equal sets are listed once. Lists of one entry go at once. The entries carry size and
   position and are sorted by size; blocks of a list whose sizes or positions cannot reach the overlap are skipped whole.
4. First pass: in each list and class of sizes, entries are held against the list's first only; every set keeps the
   pivot with which it shares most lists, and that pair is verified. A group of copies costs as many pairs as members.
5. Lists inside one component go whole. Those of more than ``LIST_ENTRIES`` are cut into blocks by size class and large
   component, and each pair of blocks that these leave open is dealt out by itself, so no task holds more of a list.
   Second pass: only entries whose sets are not yet connected form pairs, and of the pairs that a task finds, first only
   those that tie further components, the likeliest links before all others; a group of near copies is mostly connected by
   their answers, its stragglers included. Third pass: all pairs that are left between components, so that none is missed.
   A task counts the lists that a pair shares and names it once; pairs that share fewer lists in all than a link needs go.
   Where both have an answer for the same pivot, the pair's answer is bounded, and often decided, by the two known overlaps;
   parity bitmaps, as long as the sets are large, bound the rest. What remains is verified on whole sets. Pairs inside a
   component need no answer, as they cannot change it.

Defined cases: null text is empty; a text without words has no shingles and links with nothing; with fewer words than
``width`` the whole sequence is the one shingle; rows that share a ``doc_id`` are one node, linked if any of its texts
is; a null ``doc_id`` is in no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettrage.llm.components import components
from lettrage.llm.shared import released, stored, without

WIDTH, PERCENT = 4, 85
SLOTS = 1 << 22
#: Hashes counted at once when repeated shingles are looked for, and the local count from which one is reported.
COUNTED, REPEATED = 1 << 21, 3
#: Lists of up to so many entries are compared all at once; longer ones in blocks.
SHORT, LIST_BLOCK = 12, 256
#: Bits of parity that each entry of a list carries.
PARITY_BITS = 1024
#: Entries held before their lists are compared.
TOGETHER = 200_000
#: Entries of one list that are held together, in expectation; longer lists are dealt out in pairs of blocks of half as many.
LIST_ENTRIES = 100_000
#: Open pairs of a task that are held before they are counted, or before all but the likeliest ties are left.
HELD_PAIRS = 1 << 20
#: Pairs tie at once if they look alike by so much more than a link needs, and others after them, so many together.
MARGIN, TIED = 0.03, 4096
BROADCAST_IDS = 1_000_000
MULTIPLIER, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SETS = "doc_id bigint, n int, s1 bigint, s2 bigint, parity binary, digest binary, token bigint, repeats bigint"
ENTRIES = "token bigint, n int, pos int, id bigint"


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles: A-Z in lower case, words between ASCII white space."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    last = max(len(words) - width, 0)
    total = np.zeros(last + 1, dtype=np.uint64)
    for k in range(min(width, len(words))):
        total = (total + hashes[k : k + last + 1]) * MULTIPLIER
        total ^= total >> np.uint64(29)
    total *= MIX
    return np.unique(total ^ (total >> np.uint64(32)))


def needed(na, nb, percent: int):
    """The least overlap of two linked sets of these sizes: ceil(percent (na + nb) / (100 + percent))."""
    return -(-(percent * (na + nb)) // (100 + percent))


def least_shared(na, nb, percent: int):
    """The least number of lists that two linked sets share: of the set whose prefix ends first, the rest of ceil(tn) - 1
    shingles adds so many at most to the overlap."""
    return needed(na, nb, percent) - np.maximum(-(-percent * na // 100), -(-percent * nb // 100)) + 1


def encoded(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.encode("text", "utf-8").alias("bytes"))


def rows_of(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    import xxhash

    value = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return tuple(int(x) for x in np.array([value >> 64, value & (1 << 64) - 1], dtype=np.uint64).astype(np.int64))


def parity(hashes: np.ndarray, bits: int = PARITY_BITS) -> bytes:
    """Whether an odd number of the set's hashes falls on each of the bits, a power of two. Sets that differ in d elements
    differ in d bits at most."""
    return np.packbits(np.bincount((hashes & np.uint64(bits - 1)).astype(np.intp), minlength=bits) & 1).tobytes()


def digest(hashes: np.ndarray) -> bytes:
    """The parity on at least as many bits as the set has elements: enough to tell unlike sets of any size apart."""
    return parity(hashes, max(PARITY_BITS, 1 << (len(hashes) - 1).bit_length()))


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two digests differ, the longer one folded to the length of the other."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def describe(docs: DataFrame, width: int) -> DataFrame:
    """One row per document (size, fingerprint, parity), and rows (``token``, ``repeats``) of shingles that occur several
    times among the distinct sets of a task; copies within a task count once."""
    def read(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in SETS.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        rows, seen, held, size = [], set(), [], 0

        def described():
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        def repeated():
            tokens, n = np.unique(np.concatenate(held), return_counts=True)
            tokens, n = tokens[n >= REPEATED].view(np.int64), n[n >= REPEATED]
            empty = [pa.nulls(len(tokens), k) for k in kinds[:6]]
            return pa.RecordBatch.from_arrays([*empty, pa.array(tokens, pa.int64()), pa.array(n, pa.int64())], names)

        for doc_id, text in rows_of(batches):
            hashes = shingle_set(text, width)
            s1, s2 = fingerprint(hashes)
            rows.append((doc_id, len(hashes), s1, s2, parity(hashes), digest(hashes), None, None))
            if (s1, s2) not in seen:
                seen.add((s1, s2))
                held.append(hashes)
                size += len(hashes)
            if len(rows) >= 5000:
                yield described()
                rows = []
            if size >= COUNTED:
                yield repeated()
                held, size = [], 0
        if rows:
            yield described()
        if held:
            yield repeated()

    return encoded(docs).mapInArrow(released(read), SETS)


@dataclass
class Order:
    """The global order of shingles: by the class of their slot, those that don't repeat first, then by hash."""

    classes: np.ndarray

    @classmethod
    def of(cls, slots: np.ndarray, repeats: np.ndarray) -> Order:
        """Classes from the sums of slots: half powers of two."""
        classes = np.zeros(SLOTS, dtype=np.uint8)
        classes[slots] = np.minimum(1 + 2 * np.log2(np.maximum(repeats, 1)), 255).astype(np.uint8)
        return cls(classes)

    def prefix(self, hashes: np.ndarray, percent: int) -> np.ndarray:
        """The first shingles of a sorted set; within a class the hashes stay in ascending order."""
        count = len(hashes) - -(-percent * len(hashes) // 100) + 1
        classes = self.classes[(hashes & np.uint64(len(self.classes) - 1)).astype(np.intp)]
        return hashes[np.argsort(classes, kind="stable")[:count]]


def one_of_each_set(docs: DataFrame, copies: DataFrame, about: DataFrame) -> DataFrame:
    """The documents without those whose set is listed by a smaller ``doc_id``, which ``copies`` links to it; ids with several
    texts stay. Else two groups of a and b copies that share a list and don't link would be a times b pairs."""
    ids = copies.select(F.col("a").alias("doc_id")).distinct()
    return without(docs, ids.join(about.filter("mixed = 1").select(F.col("id").alias("doc_id")), "doc_id", "left_anti"))


def prefixes(docs: DataFrame, order: Order, width: int, percent: int) -> DataFrame:
    """The entries of the inverted lists; of equal texts that meet in a task only the first is listed."""
    shared = docs.sparkSession.sparkContext.broadcast(order)

    def read(batches):
        import pyarrow as pa

        names = [c.split()[0] for c in ENTRIES.split(", ")]
        seen, held, size = set(), [], 0

        def entries():
            return pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([t for t, _, _ in held]).view(np.int64)),
                pa.array(np.concatenate([np.full(len(t), n, dtype=np.int32) for t, n, _ in held])),
                pa.array(np.concatenate([np.arange(len(t), dtype=np.int32) for t, _, _ in held])),
                pa.array(np.concatenate([np.full(len(t), d, dtype=np.int64) for t, _, d in held])),
            ], names)

        for doc_id, text in rows_of(batches):
            hashes = shingle_set(text, width)
            key = fingerprint(hashes)
            if not len(hashes) or key in seen:
                continue
            seen.add(key)
            held.append((shared.value.prefix(hashes, percent), len(hashes), doc_id))
            size += len(held[-1][0])
            if size >= 100_000:
                yield entries()
                held, size = [], 0
        if held:
            yield entries()

    return encoded(docs.filter(F.col("doc_id").isNotNull())).mapInArrow(released(read), ENTRIES)


def whole_sets(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """``id, n, hashes`` of the documents in the pairs (a, b). Up to ``BROADCAST_IDS`` ids, counted first, are broadcast, so
    that only the texts of these documents go further; more ids meet the texts by shuffle."""
    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, width) for t in part.column(1).to_pylist()]
                lengths = np.cumsum([0, *map(len, sets)])
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(lengths).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(lengths.astype(np.int32)), values),
                ], ["id", "n", "hashes"])

    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "pair-ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return encoded(docs).join(ids, "doc_id", "left_semi").mapInArrow(released(read), "id bigint, n int, hashes array<bigint>")


def overlaps(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``a, b, na, nb, overlap`` of the pairs, counted on whole sets; rows that repeat a set count once."""
    sets = stored(whole_sets(docs, pairs, width), "pair-sets").dropDuplicates(["id", "n", "hashes"])
    first = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    second = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    return joined.select("a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("overlap"))


def plausible(pairs: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose digests don't rule a link out; ids with several texts always stay."""
    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            rows = zip(*[c.to_pylist() for c in batch.columns])
            kept = [
                (a, b) for a, b, na, nb, da, db, mixed in rows if mixed or (na + nb - differing(da, db)) // 2 >= needed(na, nb, percent)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], pa.int64()) for k in (0, 1)], ["a", "b"])

    first = about.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("digest").alias("da"), F.col("mixed").alias("ma"))
    second = about.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("digest").alias("db"), F.col("mixed").alias("mb"))
    joined = pairs.select("a", "b").join(first, "a").join(second, "b")
    return joined.select("a", "b", "na", "nb", "da", "db", (F.col("ma") + F.col("mb") > 0).alias("mixed")).mapInArrow(released(judge), "a bigint, b bigint")


def linked(percent: int):
    return F.col("overlap") * 100 >= (F.col("na") + F.col("nb") - F.col("overlap")) * percent


def to_pivots(lists: DataFrame, percent: int) -> DataFrame:
    """``a, b``: every set with the pivot it shares most lists with, where these are a quarter of its prefix at least; the
    pivot is the first of its list and size class. Which pairs are tried here has no effect on the result."""
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    classed = lists.withColumn("size_class", size_class)
    first = Window.partitionBy("token", "size_class").orderBy("n", "id").rowsBetween(Window.unboundedPreceding, 0)
    tied = classed.withColumn("pivot", F.first("id").over(first)).filter("id <> pivot")
    shared = tied.groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n"))
    likely = shared.filter(F.col("shared") * 400 >= F.col("n") * (100 - percent))
    best = likely.groupBy("id").agg(F.max(F.struct("shared", (-F.col("pivot")).alias("back"), "pivot")).alias("best"))
    return best.select(F.col("id").alias("a"), F.col("best.pivot").alias("b"))


class Lists:
    """Consecutive inverted lists as columns, sorted by token, then size, and the pairs within them that stay open."""

    def __init__(self, columns: list[np.ndarray], percent: int, half: np.ndarray | None = None):
        self.token, self.n, self.pos, self.ids, self.comp, self.pivot, self.pivot_n, self.known, self.mixed, self.bits = columns
        self.percent = percent
        #: 1 and 2 for the two blocks of a longer list, of which only pairs across are tried; 0 for whole lists.
        self.half = np.zeros(len(self.token), dtype=np.int64) if half is None else half

    def open_pairs(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the entries x and y the pairs that no bound rules out, and whether what is known proves their link."""
        na, nb, pa, pb = self.n[x], self.n[y], self.pos[x], self.pos[y]
        need = needed(na, nb, self.percent)
        most = np.minimum(pa, pb) + np.minimum(na - pa, nb - pb)
        keep = (self.comp[x] != self.comp[y]) & (most >= need) & ((self.half[x] == 0) | (self.half[x] != self.half[y]))
        x, y, need = x[keep], y[keep], need[keep]
        differing = np.bitwise_count(self.bits[x] ^ self.bits[y]).sum(1).astype(np.int64)
        keep = (self.n[x] + self.n[y] - np.where(self.mixed[x] + self.mixed[y] > 0, 0, differing)) // 2 >= need
        x, y, need = x[keep], y[keep], need[keep]
        kx, ky = self.known[x], self.known[y]
        both = (self.pivot[x] == self.pivot[y]) & (kx >= 0) & (ky >= 0)
        most = np.minimum(kx, ky) + np.minimum(self.n[x] - kx, self.n[y] - ky)
        sure = both & (kx + ky - self.pivot_n[x] >= need)
        keep = ~both | (most >= need)
        return x[keep], y[keep], sure[keep]

    def likeness(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The Jaccard similarities of the pairs as their parities suggest, to order them by; a bitmap with half its bits
        unlike says nothing more."""
        bits = np.bitwise_count(self.bits[x] ^ self.bits[y]).sum(1) / PARITY_BITS
        apart = -PARITY_BITS / 2 * np.log(np.maximum(1 - 2 * bits, 1e-3))
        both = self.n[x] + self.n[y]
        return np.maximum(both - apart, 0) / (both + apart)

    def found(self):
        edges = np.flatnonzero(np.concatenate([[True], self.token[1:] != self.token[:-1], [True]]))
        sizes = np.diff(edges)
        size_of, left = np.repeat(sizes, sizes), np.repeat(edges[1:], sizes) - np.arange(len(self.token)) - 1
        for step in range(1, SHORT):  # all short lists at once, by distance between entries
            x = np.flatnonzero((size_of <= SHORT) & (left >= step))
            if not len(x):
                break
            yield self.open_pairs(x, x + step)
        for begin, size in zip(edges[:-1][sizes > SHORT].tolist(), sizes[sizes > SHORT].tolist()):
            yield from self.of_long_list(begin, begin + size)

    def of_long_list(self, begin: int, end: int):
        """Block by block: blocks are passed over where sizes are too far apart, positions too late, or components one."""
        comps = self.comp[begin:end]
        if (comps == comps[0]).all():
            return
        blocks = [(k, min(k + LIST_BLOCK, end)) for k in range(begin, end, LIST_BLOCK)]
        for number, (i, i_end) in enumerate(blocks):
            rest = (self.n[i:i_end] - self.pos[i:i_end]).max()
            for j, j_end in blocks[number:]:
                if self.n[j] * self.percent > 100 * self.n[i_end - 1]:
                    break  # sizes only grow from here on
                if min(self.pos[i:i_end].max(), self.pos[j:j_end].max()) + rest < needed(self.n[i], self.n[j], self.percent):
                    continue
                apart = self.comp[i:i_end, None] != self.comp[None, j:j_end]
                apart &= (self.half[i:i_end, None] == 0) | (self.half[i:i_end, None] != self.half[None, j:j_end])
                if i == j:
                    apart = np.triu(apart, 1)
                x, y = np.nonzero(apart)
                if len(x):
                    yield self.open_pairs(x + i, y + j)


def in_groups(lists: DataFrame, percent: int) -> DataFrame:
    """The entries of lists with several components: ``token`` names what is compared together, a list or a pair of blocks of
    one, and ``half`` the block. Linked sets are at most one size class apart."""
    sizes = lists.groupBy("token").agg(F.count(F.lit(1)).alias("held"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    sizes = stored(sizes.filter("least < most").select("token", "held"), "open-lists")
    number, longer = sizes.agg(F.count(F.lit(1)), F.count_if(F.col("held") > LIST_ENTRIES)).first()
    short = sizes.filter(F.col("held") <= LIST_ENTRIES).select("token")
    whole = lists.join(F.broadcast(short) if number <= BROADCAST_IDS else short, "token", "left_semi").withColumn("half", F.lit(0))
    if not longer:
        return whole
    block = max(1, LIST_ENTRIES // 2)
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) * (1 - 1e-9)).cast("int")
    # Both tables have fewer rows than the lists have entries by a factor of ``block``.
    long = lists.join(F.broadcast(sizes.filter(F.col("held") > LIST_ENTRIES).select("token")), "token").withColumn("size_class", size_class)
    large = stored(long.groupBy("token", "comp").count().filter(F.col("count") > block).select("token", "comp"), "large-components")
    long = long.join(F.broadcast(large.withColumn("large", F.lit(True))), ["token", "comp"], "left")
    long = long.withColumns({"large": F.coalesce("large", F.lit(False)), "owner": F.when(F.col("large"), F.col("comp")).otherwise(0)})
    cell = ["token", "large", "owner", "size_class"]
    cells = long.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    cells = stored(cells, "list-cells")
    order = Window.partitionBy("token").orderBy(*cell[1:], "k")
    blocks = cells.select(*cell, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("k")).withColumn("number", F.row_number().over(order))
    blocks = stored(blocks, "list-blocks")
    other = blocks.select(F.col("token").alias("of"), *[F.col(c).alias(f"other_{c}") for c in ("large", "owner", "size_class", "number")])
    meet = (
        (F.col("token") == F.col("of")) & (F.abs(F.col("size_class") - F.col("other_size_class")) <= 1)
        & ~(F.col("large") & F.col("other_large") & (F.col("owner") == F.col("other_owner")))
    )
    group = F.xxhash64("token", F.least("number", "other_number"), F.greatest("number", "other_number"))
    half = F.when(F.col("number") == F.col("other_number"), 0).when(F.col("number") < F.col("other_number"), 1).otherwise(2)
    deals = blocks.join(other, meet).groupBy(*cell, "k").agg(F.collect_list(F.struct(group.alias("group"), half.alias("half"))).alias("deals"))
    placed = long.join(F.broadcast(cells), cell).withColumn("k", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = placed.join(F.broadcast(stored(deals, "list-deals")), [*cell, "k"]).select(*[c for c in lists.columns if c != "token"], F.explode("deals").alias("deal"))
    return whole.unionByName(dealt.select("*", F.col("deal.group").alias("token"), F.col("deal.half").alias("half")).drop("deal"))


class Forest:
    """Which components pairs have tied so far, in one task's lists; what is passed on ties two that weren't."""

    def __init__(self, comps: np.ndarray):
        self.names = np.unique(comps)
        self.root = np.arange(len(self.names))

    def copy(self) -> Forest:
        same = Forest(self.names)
        same.root = self.root.copy()
        return same

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pairs of components are not tied yet."""
        return self.root[np.searchsorted(self.names, left)] != self.root[np.searchsorted(self.names, right)]

    def ties(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pairs of components that tie new ones, in order."""
        x, y = np.searchsorted(self.names, left), np.searchsorted(self.names, right)
        found, root = [], self.root
        for i in np.flatnonzero(root[x] != root[y]).tolist():
            a, b = int(x[i]), int(y[i])
            while root[a] != a:
                a = int(root[a])
            while root[b] != b:
                b = int(root[b])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append(i)
        if found:
            while True:
                further = root[root]
                if (further == root).all():
                    break
                root = further
            self.root = root
        return np.array(found, dtype=np.intp)


def tying(lists: Lists):
    """Entries x, y, and whether their link is sure, of pairs that tie further components: fewer than entries. Sure and very
    like pairs tie as they come; of the others the likeliest first, so that a set at the edge of a group is asked against
    the members that it most likely links with."""
    forest, held, size = Forest(lists.comp), [], 0

    def likeliest(forest: Forest):
        x, y, sure, like = [np.concatenate(c) for c in zip(*held)]
        order, kept = np.argsort(-like, kind="stable"), [np.zeros(0, dtype=np.intp)]
        for at in range(0, len(order), TIED):
            part = order[at : at + TIED]
            kept.append(part[forest.ties(lists.comp[x[part]], lists.comp[y[part]])])
        kept = np.concatenate(kept)
        return x[kept], y[kept], sure[kept], like[kept]

    for x, y, sure in lists.found():
        apart = forest.apart(lists.comp[x], lists.comp[y])
        x, y, sure = x[apart], y[apart], sure[apart]
        if not len(x):
            continue
        like = lists.likeness(x, y)
        early = np.flatnonzero(sure | (like >= lists.percent / 100 + MARGIN))
        early = early[forest.ties(lists.comp[x[early]], lists.comp[y[early]])]
        yield x[early], y[early], sure[early]
        apart = forest.apart(lists.comp[x], lists.comp[y])
        if apart.any():
            held.append((x[apart], y[apart], sure[apart], like[apart]))
            size += len(held[-1][0])
        if size >= HELD_PAIRS:
            held = [likeliest(forest.copy())]
            size = 0
    if held:
        yield likeliest(forest)[:3]


def counted(pairs: list[tuple]) -> list[np.ndarray]:
    """Columns a, b, sure, shared, least with each pair once: sure if it is once, ``shared`` added up."""
    a, b, sure, shared, least = [np.concatenate(c) for c in zip(*pairs)]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return [
        a[first], b[first], np.logical_or.reduceat(sure[order], first), np.add.reduceat(shared[order], first), np.minimum.reduceat(least[order], first)
    ]


def unconnected_pairs(lists: DataFrame, percent: int, spanning: bool = False) -> DataFrame:
    """``a, b, sure``: pairs of sets in different components that share enough lists and that no bound rules out; ``sure``
    pairs link by what is known of their common pivot. Ids with several texts have no bounds (``known`` -1, ``mixed`` 1). With
    ``spanning``, of the pairs that a task finds together only those that tie further components."""
    def read(batches):
        import pyarrow as pa

        def named(pairs):
            return pa.RecordBatch.from_arrays([pa.array(c) for c in counted(pairs)], ["a", "b", "sure", "shared", "least"])

        def finish(parts):
            *columns, half, bits = [np.concatenate(c) for c in zip(*parts)]
            lists = Lists([*columns, bits], percent, half)
            pairs, size = [], 0
            for x, y, sure in tying(lists) if spanning else lists.found():
                if not len(x):
                    continue
                a, b = lists.ids[x], lists.ids[y]
                least = least_shared(lists.n[x], lists.n[y], percent)
                least[(lists.mixed[x] + lists.mixed[y] > 0) | spanning] = 0
                pairs.append((np.minimum(a, b), np.maximum(a, b), sure, np.ones(len(x), dtype=np.int64), least))
                size += len(x)
                if size >= HELD_PAIRS:
                    yield named(pairs)
                    pairs, size = [], 0
            if pairs:
                yield named(pairs)

        held: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:-1]]
            bits = np.frombuffer(b"".join(batch.columns[-1].to_pylist()), dtype=np.uint64).reshape(-1, PARITY_BITS // 64)
            held.append([*columns, bits])
            if sum(len(p[0]) for p in held) < TOGETHER:
                continue
            last = held[-1][0][-1]  # this list may go on in the next batch
            ready = [[c[: np.searchsorted(p[0], last)] for c in p] if p[0][-1] == last else p for p in held]
            held = [[c[np.searchsorted(p[0], last):] for c in p] for p in held if p[0][-1] == last]
            ready = [p for p in ready if len(p[0])]
            if ready:
                yield from finish(ready)
        if held:
            yield from finish(held)

    columns = ["token", "n", "pos", "id", "comp", "pivot", "pivot_n", "known", "mixed", "half", "parity"]
    dealt = lists.select(columns).repartition("token").sortWithinPartitions("token", "n", "id")
    found = dealt.mapInArrow(released(read), "a bigint, b bigint, sure boolean, shared bigint, least bigint")
    found = found.groupBy("a", "b").agg(F.max("sure").alias("sure"), F.sum("shared").alias("shared"), F.min("least").alias("least"))
    return found.filter("sure or shared >= least").select("a", "b", "sure")


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    spark = docs.sparkSession
    described = stored(describe(docs, width), "sets")
    slot = F.col("token").bitwiseAND(F.lit(SLOTS - 1).cast("bigint")).cast("int").alias("slot")
    repeated = described.filter(F.col("token").isNotNull()).groupBy(slot).agg(F.sum("repeats").alias("repeats")).toArrow()  # SLOTS rows at most
    order = Order.of(repeated.column(0).to_numpy(), repeated.column(1).to_numpy())
    sets = described.filter(F.col("token").isNull())
    full = sets.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    copies = full.join(
        full.groupBy("s1", "s2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most"), ["s1", "s2"]
    ).select(F.col("doc_id").alias("a"), F.col("least").alias("b")).filter("a <> b")

    about = stored(full.groupBy(F.col("doc_id").alias("id")).agg(
        F.first("n").alias("n"), F.first("parity").alias("parity"), F.first("digest").alias("digest"),
        ((F.min("s1") < F.max("s1")) | (F.min("s2") < F.max("s2"))).cast("int").alias("mixed"),
    ), "digests")
    copies = stored(copies, "copies")
    entries = prefixes(one_of_each_set(docs, copies, about), order, width, percent).repartition("token")
    lists = entries.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("held > 1").drop("held")
    lists = stored(lists, "lists")
    first = stored(overlaps(stored(plausible(to_pivots(lists, percent), about, percent), "pivots"), docs, width), "pivot-answers")
    links = copies.unionByName(first.filter(linked(percent)).select("a", "b"))
    near = components(links)

    known = first.groupBy(F.col("a").alias("id")).agg(
        F.first("b").alias("pivot"), F.min("nb").alias("pivot_n"), F.max("overlap").alias("known"), F.count(F.lit(1)).alias("answers")
    )
    def open_pairs(near: DataFrame, spanning: bool) -> DataFrame:
        placed = lists.join(near.select(F.col("node").alias("id"), "component"), "id", "left")
        placed = stored(placed.select("token", "n", "pos", "id", F.coalesce("component", "id").alias("comp")), "placed-lists")
        listed = (
            in_groups(placed, percent).join(known, "id", "left").join(about.select("id", "parity", "mixed"), "id")
            .select("token", "n", "pos", "id", "comp", F.coalesce("pivot", F.lit(0)).alias("pivot"),
                    F.coalesce("pivot_n", F.lit(0)).alias("pivot_n"),
                    F.when((F.col("answers") == 1) & (F.col("mixed") == 0), F.col("known")).otherwise(-1).alias("known"), "mixed", "half", "parity")
        )
        return unconnected_pairs(listed, percent, spanning)

    def answered(pairs: DataFrame) -> DataFrame:
        """The pairs that link: sure ones, and those of the rest whose whole sets do."""
        unsure = stored(plausible(pairs.filter("not sure"), about, percent), "unsure-pairs")
        return overlaps(unsure, docs, width).filter(linked(percent)).select("a", "b").unionByName(pairs.filter("sure").select("a", "b"))

    ties = stored(open_pairs(near, True), "tying-pairs")
    links = stored(links.unionByName(answered(ties)), "links")
    rest = open_pairs(stored(components(links), "components"), False).join(ties.select("a", "b"), ["a", "b"], "left_anti")
    found = components(links.unionByName(answered(stored(rest, "open-pairs"))))
    return sets.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )
