"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

Words are runs of letters, marks and digits in lower case; features are shingles of five words, with their number of
occurrences as weight. An item's fingerprint has 128 bits. A window is as long as the item it is held against; all windows
are formed in which so many positions hold shingles of items of that size as the similarity takes, in whatever order, as no
other can reach it. Equal windows are fingerprinted and compared once, however many documents hold them.

Fingerprints meet by multi-index blocks: two of them within ``RADIUS`` bits differ by at most four bits in one of eight
blocks of 16 bits; items list each block with all changes of up to three bits and windows with up to one, so every such pair
meets in a block. Pairs that meet within the radius are compared exactly: sum of the smaller over sum of the larger
shingle counts, which has to reach ``SIMILARITY``.

Defined cases: null or wordless text, and items without words, match nothing; an item of fewer than five words is one
shingle, held against runs of as many words; a document shorter than an item is one window; documents that share an id
are one; a null ``doc_id`` is reported as such; repeated items are reported once per id; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import documents, stored

WORDS = 5
SIMILARITY = 0.8
RADIUS = 39
BLOCKS, BLOCK_BITS = 8, 16
ITEM_CHANGES, WINDOW_CHANGES = 3, 1
#: Largest number of benchmark shingles that are broadcast, about 50 MB; a larger benchmark is joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Largest number of items whose block keys are broadcast, some 5,600 each of 200 bytes, so about 22 MB; the small file they are
#: made from would let the planner broadcast any number of them.
BROADCAST_ITEMS = 20


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", -1), lambda w: w != "")


def shingles(words: Column, width: Column | int, join) -> Column:
    """``join(word, position)`` of every position at which a shingle of ``width`` words begins."""
    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - width + 1, F.lit(0))), join)


def hashed(words: Column, width: int) -> Column:
    return shingles(words, width, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)]))


def spelled(words: Column, width: Column) -> Column:
    return shingles(words, width, lambda w, i: F.array_join(F.slice(words, i + 1, width), " "))


def fingerprint(hashes: str) -> Column:
    """64 bits: each is set where more than half of the hashes in that column have it set."""
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")

    def add(bits: Column, b: Column) -> Column:
        ones = F.aggregate(hashes, zero, lambda n, h: n + F.call_function("shiftright", h, b).bitwiseAND(one))
        return bits.bitwiseOR(F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(zero))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), zero, add)


def fingerprints(frame: DataFrame) -> DataFrame:
    """The frame with ``f0`` and ``f1`` from its column ``features``."""
    halves = [F.transform("features", lambda s: F.xxhash64(s)).alias("h0"), F.transform("features", lambda s: F.xxhash64(F.lit(1), s)).alias("h1")]
    return frame.select("*", *halves).select(*frame.columns, fingerprint("h0").alias("f0"), fingerprint("h1").alias("f1"))


def changes(most: int) -> Column:
    """All 16-bit masks with up to ``most`` bits."""
    masks = [sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(BLOCK_BITS), k)]
    return F.array(*map(F.lit, masks))


def block_keys(most: int) -> Column:
    """(block, value) of every block of ``f0`` and ``f1`` under every change of up to ``most`` bits."""
    per_half = 64 // BLOCK_BITS

    def value(number: int) -> Column:
        at = BLOCK_BITS * (number % per_half)
        return F.shiftrightunsigned(f"f{number // per_half}", at).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("bigint")).cast("int")

    blocks = F.array(*[F.struct(F.lit(n).alias("block"), value(n).alias("value")) for n in range(BLOCKS)])
    return F.flatten(F.transform(blocks, lambda b: F.transform(
        changes(most), lambda m: F.struct(b["block"].alias("block"), b["value"].bitwiseXOR(m).alias("value"))
    )))


def item_table(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, size, width, features, f0, f1`` of the items that have words."""
    worded = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"), words_of(F.coalesce("text", F.lit(""))).alias("words")
    ).filter(F.size("words") > 0).dropDuplicates(["item_id", "words"])
    sized = worded.withColumns({"size": F.size("words"), "width": F.least(F.size("words"), F.lit(WORDS))})
    return fingerprints(sized.withColumn("features", spelled(F.col("words"), F.col("width"))))


def candidate_windows(docs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``doc_id, body, size, width, start``: every window that holds enough shingles of the items of its size. Bags of a and
    b shingles that reach the similarity s have s (a + b) / (1 + s) in common at least."""
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())
    found = None
    for width in widths:
        grams = items.filter(F.col("width") == width).select("size", F.explode(hashed(F.col("words"), width)).alias("h")).distinct()
        grams = F.broadcast(grams) if grams.count() <= BROADCAST_ROWS else grams
        rows = docs.select("doc_id", "body", F.size("words").alias("n"), F.posexplode(hashed(F.col("words"), width)).alias("pos", "h"))
        held = rows.join(grams, "h").groupBy("doc_id", "body", "n", "size").agg(F.sort_array(F.collect_set("pos")).alias("at"))
        part = held.withColumn("width", F.lit(width))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.select("doc_id", "body", *[F.lit(0).alias(c) for c in ("size", "width", "start")]).filter("false")
    whole, own = [least - F.col("width") + 1 for least in (F.col("size"), F.least("size", "n"))]
    need = F.greatest(F.lit(1), F.ceil((whole + own) * F.lit(similarity / (1 + similarity)) - 1e-9).cast("int"))
    enough = found.withColumns({"whole": whole, "need": need}).filter(F.size("at") >= F.col("need"))

    def starts(i: Column) -> Column:
        """The starts of windows whose first shared shingle is number ``i`` and that reach the one ``need`` - 1 further on."""
        low = F.greatest(F.lit(0), F.get("at", i - 1) + 1, F.get("at", i + F.col("need") - 1) - F.col("whole") + 1)
        high = F.least(F.get("at", i), F.greatest(F.lit(0), F.col("n") - F.col("size")))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    firsts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("at") - F.col("need")))
    return enough.select("doc_id", "body", "size", "width", F.explode(F.flatten(F.transform(firsts, starts))).alias("start"))


def similarities(pairs: DataFrame) -> DataFrame:
    """``k1, k2, size, item_id, similarity`` of pairs of a window's ``features`` and an item's ``item_features``."""
    keys = ["k1", "k2", "size", "item_id"]
    sides = [
        pairs.select(*keys, F.explode(column).alias("shingle"), F.lit(1 - side).alias("here"), F.lit(side).alias("there"))
        for side, column in enumerate(("features", "item_features"))
    ]
    counts = sides[0].unionByName(sides[1]).groupBy(*keys, "shingle").agg(F.sum("here").alias("here"), F.sum("there").alias("there"))
    return counts.groupBy(*keys).agg((F.sum(F.least("here", "there")) / F.sum(F.greatest("here", "there"))).alias("similarity"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``doc_id, item_id, similarity, start, n_words``: one row per document and item it holds, with its best window,
    counted in words from 0."""
    items = stored(item_table(benchmark), "items")
    texts = documents(docs).filter(F.length("text") > 0).select("doc_id", F.xxhash64("text").alias("body"), words_of(F.col("text")).alias("words"))
    spots = stored(candidate_windows(texts, items, similarity), "windows")
    spot = spots.select(F.col("doc_id").alias("of"), F.col("body").alias("of_body"), "size", "width", "start")
    windows = texts.join(spot, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("body") == F.col("of_body"))).select(
        "doc_id", "size", "width", "start", F.slice(F.col("words"), F.col("start") + 1, F.col("size")).alias("window")
    ).withColumns({"k1": F.xxhash64("window"), "k2": F.xxhash64(F.lit(2), "window")})
    windows = stored(windows, "window-words")

    distinct = windows.dropDuplicates(["k1", "k2", "size"]).select("k1", "k2", "size", spelled(F.col("window"), F.least("width", F.size("window"))).alias("features"))
    prints = stored(fingerprints(distinct), "fingerprints")
    listed = prints.select("k1", "k2", "size", "f0", "f1", F.explode(block_keys(WINDOW_CHANGES)).alias("key"))
    indexed = items.select("item_id", F.col("size").alias("of_size"), F.col("f0").alias("g0"), F.col("f1").alias("g1"), F.explode(block_keys(ITEM_CHANGES)).alias("of_key"))
    if items.count() > BROADCAST_ITEMS:
        indexed = indexed.hint("shuffle_merge")
    distance = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1")))
    near = (
        listed.join(indexed, (F.col("size") == F.col("of_size")) & (F.col("key") == F.col("of_key"))).filter(distance <= radius)
        .select("k1", "k2", "size", "item_id").distinct()
    )
    pairs = near.join(prints.select("k1", "k2", "size", "features"), ["k1", "k2", "size"]).join(
        items.select("item_id", F.col("size").alias("of_size"), F.col("features").alias("item_features")), "item_id"
    ).filter("size = of_size")
    alike = similarities(pairs).filter(F.col("similarity") >= similarity)
    hits = windows.select("doc_id", "k1", "k2", "size", "start", F.size("window").alias("n_words")).join(alike, ["k1", "k2", "size"])
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words"))
    return hits.groupBy("doc_id", "item_id").agg(best.alias("best")).select(
        "doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start"), "best.n_words"
    )
