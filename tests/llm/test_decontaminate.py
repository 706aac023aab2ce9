"""Decontamination against all windows of all documents in plain Python."""

import re
from collections import Counter

from pyspark.sql import functions as F

from lettrage.llm import decontaminate


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(seq, width):
    return Counter(tuple(seq[i : i + width]) for i in range(len(seq) - width + 1))


def brute(docs, items):
    found = {}
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            if not v or not w:
                continue
            width = min(5, len(v))
            want = grams(v, width)
            for s in range(max(1, len(w) - len(v) + 1)):
                got = grams(w[s : s + len(v)], width)
                whole = sum((got | want).values())
                share = sum((got & want).values()) / whole if whole else 0
                if share >= 0.8:
                    found[d, i] = max(found.get((d, i), 0), share)
    return found


def leaks(docs, items):
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.find_leaks(docs, items).collect()}


def test_given_tables(spark, table):
    items = table("benchmark")
    known = {g for r in items.collect() for g in grams(words(r["text"]), 5)}
    shared = {r["doc_id"]: sum(g in known for g in grams(words(r["text"]), 5)) for r in table("documents").collect()}
    chosen = sorted(shared, key=lambda d: (-shared[d], d))[:20] + sorted(shared)[:20]
    docs = table("documents").filter(F.col("doc_id").isin(chosen))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    got = leaks(docs, items)
    assert want and {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


def test_planted_edits_and_defined_cases(spark):
    item = " ".join(f"w{i}" for i in range(60))
    other = [f"w{i}" for i in range(60)]
    edited, cut, twice = list(other), other[4:], other[:20] + ["in", "between"] + other[20:]
    edited[30] = "changed"
    broken = [w if i % 4 else f"x{i}" for i, w in enumerate(other)]
    texts = [
        (1, "before it " + item.upper() + ", and after"), (2, " ".join(edited)), (3, " ".join(cut)), (4, "a " * 200 + " ".join(twice)),
        (5, " ".join(broken)), (6, None), (7, ""), (8, "..."), (9, "one two three"), (9, item), (None, item), (10, "la la la la la la la la la la"),
        (11, "la la la la la la la la la x la la"), (12, "w0-w1_w2, " + item),
    ]
    items = [(1, item), (2, "one two three"), (3, None), (4, "?"), (1, item), (5, "la " * 10)]
    docs = spark.createDataFrame([(d, t, 3, "x") for d, t in texts], "doc_id long, text string, size int, words string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, start int")
    want = brute(texts, items)
    assert {(1, 1), (2, 1), (4, 1), (9, 1), (9, 2), (None, 1), (10, 5)} <= set(want) and (5, 1) not in want
    got = leaks(docs, bench)
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    assert leaks(docs.filter("false"), bench) == {} and leaks(docs, bench.filter("false")) == {}


def test_reordered_items_and_windows_between_alignments(spark):
    item, short = [f"w{i}" for i in range(60)], [f"v{i}" for i in range(40)]
    around = [[f"{side}{i}" for i in range(80)] for side in "ab"]
    swapped = {
        1: item[30:] + item[:30], 2: item[20:] + item[:20], 3: item[40:] + item[20:40] + item[:20], 4: short[20:] + short[:20], 5: short[25:] + short[:25],
    }
    texts = [(d, " ".join(around[0] + w + around[1])) for d, w in swapped.items()]
    texts += [(6, " ".join(swapped[1])), (7, " ".join(swapped[1] + swapped[4] + item)), (7, " ".join(swapped[2][2:])), (8, " ".join(item[:50])), (8, " ".join(item[:50]))]
    items = [(1, " ".join(item)), (2, " ".join(short)), (3, " ".join(around[1][:60]))]
    docs, bench = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(texts, items)
    assert {(1, 1), (2, 1), (6, 1), (4, 2), (7, 1)} <= set(want) and abs(want[1, 1] - 52 / 60) < 1e-9
    assert {k: round(v, 9) for k, v in leaks(docs, bench).items()} == {k: round(v, 9) for k, v in want.items()}


def test_fingerprints_within_the_radius_meet(spark):
    import random

    rng = random.Random(3)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for n in range(60):
        f = rng.getrandbits(128)
        g = f
        for b in rng.sample(range(128), 31):
            g ^= 1 << b
        rows.append((n, *[signed(v >> s & (1 << 64) - 1) for v in (f, g) for s in (0, 64)]))
    frame = spark.createDataFrame(rows, "n int, a0 long, a1 long, b0 long, b1 long")
    left = frame.selectExpr("n", "a0 AS f0", "a1 AS f1").select("n", decontaminate.block_keys(decontaminate.ITEM_CHANGES).alias("k"))
    right = frame.selectExpr("n AS m", "b0 AS f0", "b1 AS f1").select("m", decontaminate.block_keys(decontaminate.WINDOW_CHANGES).alias("j"))
    assert left.join(right, left["n"] == right["m"]).filter("arrays_overlap(k, j)").count() == 60


def test_no_pair_near_the_threshold_is_lost(spark):
    """Items with one changed word, some five shingles of 56: the farthest that pairs of this similarity lie apart."""
    texts = {i: [f"w{(i * 7919 + k * 104729) % 99991}" for k in range(60)] for i in range(800)}
    changed = {i: [*w[:30], "changed", *w[31:]] for i, w in texts.items()}
    table = lambda name, rows: spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], f"{name} long, text string")
    found = leaks(table("doc_id", changed), table("item_id", texts))
    assert {k for k in found if k[0] == k[1]} == {(i, i) for i in texts} and all(abs(found[i, i] - 51 / 61) < 1e-9 for i in texts)


def test_very_long_text(spark):
    item = " ".join(f"w{i}" for i in range(40))
    long = " ".join(f"x{i % 977}" for i in range(60_000)) + " " + item + " " + " ".join(f"y{i % 991}" for i in range(60_000))
    table = lambda name, text: spark.createDataFrame([(1, text)], f"{name} long, text string")
    assert leaks(table("doc_id", long), table("item_id", item)) == {(1, 1): 1.0}


def test_keys_of_more_than_a_few_items_are_not_broadcast(spark):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(30)]
    docs = [(i, f"before it {text} and after") for i, text in items]
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert "SortMergeJoin [size" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["doc_id"], r["item_id"], r["start"]) for r in found.collect()) == [(i, i, 2) for i, _ in items]
