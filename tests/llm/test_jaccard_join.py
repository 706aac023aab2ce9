"""The Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np

from lettrage.llm import jaccard_join
from lettrage.llm.components import components


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, percent):
    sets = [(d, shingles(t, width)) for d, t in rows]
    near = {d: {d} for d, _ in sets if d is not None}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and 100 * len(x & y) >= percent * len(x | y):
                whole = near[a] | near[b]
                for d in whole:
                    near[d] = whole
    return sorted(((d is not None, d or 0), len(s), min(near[d]) if d is not None else None) for d, s in sets)


def groups(docs, width=4, percent=85):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_groups(docs, width, percent).collect())


def test_copies_chains_and_defined_cases(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one Two"), (1004, "ONE two"), (1005, "É é"), (1006, "é é"), (None, "one two"), (1007, "x\x1cy")]
    for group in range(6):
        base = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.randrange(40, 400))]
        for _ in range(12):
            text = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) // 40))):
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
            base = text if group % 2 else base
    rows += [(7, rows[20][1]), (7, rows[40][1]), (500, rows[20][1]), (500, rows[20][1])]
    docs = spark.createDataFrame([(d, t, 1, "q") for d, t in rows], "doc_id long, text string, token int, parity string").repartition(5)
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "SHORT", 3)
    monkeypatch.setattr(jaccard_join, "TOGETHER", 50)
    for width, percent in ((4, 85), (5, 80)):
        want = brute(rows, width, percent)
        assert groups(docs, width, percent) == want
    assert len({w[2] for w in want}) < len(want) - 40
    assert groups(docs.filter("false")) == []


def test_long_lists_are_dealt_out_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_ENTRIES", 40)
    rng = np.random.default_rng(2)
    # List 1: a component of 300 and 60 others of two sizes; 2: one component; 3: short; 4: all components differ.
    rows = [(1, int(rng.integers(100, 110)), 0, i, 7 if i < 300 else i) for i in range(330)] + [(1, 105 if i % 2 else 900, 0, i, i) for i in range(330, 360)]
    rows += [(2, 100, 0, i, 7) for i in range(200)] + [(3, 100, 0, i, i) for i in range(20)] + [(4, int(n), 0, 1000 + i, i) for i, n in enumerate(rng.integers(80, 130, 150))]
    lists = spark.createDataFrame(rows, "token long, n int, pos int, id long, comp long").repartition(3)
    dealt = {}
    for r in jaccard_join.in_groups(lists, 85).collect():
        dealt.setdefault(r["token"], []).append((r["id"], r["n"], r["comp"], r["half"]))
    assert max(map(len, dealt.values())) <= 80 and 2 not in dealt and len(dealt[3]) == 20
    met = [
        (min(a[0], b[0]), max(a[0], b[0])) for g, rows_ in dealt.items() if g != 3
        for k, a in enumerate(rows_) for b in rows_[:k] if a[2] != b[2] and (a[3] == 0 or a[3] != b[3])
    ]
    for token in (1, 4):
        of = [r for r in rows if r[0] == token]
        want = {(x[3], y[3]) for x in of for y in of if x[3] < y[3] and x[4] != y[4] and 100 * min(x[1], y[1]) >= 85 * max(x[1], y[1])}
        assert want <= set(met)
    texts = [(i, " ".join([f"w{k}" for k in range(60)][: 60 - i % 3] + [f"x{i % 9}"] * (i % 5))) for i in range(90)] + [(100 + i, f"a{i} b c d e f") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard_join, "LIST_ENTRIES", 6)
    assert groups(docs) == brute(texts, 4, 85)


def test_prefix_of_ordered_sets_is_complete():
    rng = np.random.default_rng(1)
    order = jaccard_join.Order.of(np.arange(0, 40, 3), rng.integers(1, 5, 14))
    for _ in range(200):
        a = np.unique(rng.integers(0, 60, 30)).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 60, 2).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            assert len(np.intersect1d(order.prefix(a, 85), order.prefix(b, 85)))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 200: 0, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_open_pairs_against_all_pairs(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT", 3)
    monkeypatch.setattr(jaccard_join, "LIST_BLOCK", 4)
    rng = np.random.default_rng(7)
    order, columns, sets = jaccard_join.Order.of(np.zeros(0, int), np.zeros(0, int)), [], []
    for i in range(60):
        base = np.arange(100, dtype=np.uint64) * np.uint64(3) if i % 3 else np.arange(90, 200, dtype=np.uint64) * np.uint64(3)
        kept = base[rng.random(len(base)) < (0.98 if i % 2 else 0.9)]
        sets.append(np.unique(np.concatenate([kept, rng.integers(700, 900, 3).astype(np.uint64)])))
        prefix = order.prefix(sets[-1], 85)
        columns += [(int(t), len(sets[-1]), p, i, i, 0, 0, -1, 0, jaccard_join.parity(sets[-1])) for p, t in enumerate(prefix)]
    columns.sort(key=lambda r: (r[0], r[1], r[3]))
    arrays = [np.array([r[k] for r in columns], dtype=np.int64) for k in range(9)]
    arrays.append(np.frombuffer(b"".join(r[9] for r in columns), dtype=np.uint64).reshape(-1, jaccard_join.PARITY_BITS // 64))
    lists = jaccard_join.Lists(arrays, 85)
    got = {(min(a, b), max(a, b)) for x, y, _ in lists.found() for a, b in zip(lists.ids[x].tolist(), lists.ids[y].tolist())}
    want = {(i, j) for i in range(60) for j in range(i + 1, 60) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert len(want) > 50 and want <= got


def test_digests_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (5, 250, 3000):
        for m in (n, n * 3):
            a, b = np.unique(rng.integers(0, 2**62, n).astype(np.uint64)), rng.integers(0, 2**62, m).astype(np.uint64)
            b = np.unique(np.concatenate([a[: n // 2], b]))
            assert jaccard_join.differing(jaccard_join.digest(a), jaccard_join.digest(b)) <= len(np.setxor1d(a, b))
    a, b = (np.unique(rng.integers(0, 2**62, 3000).astype(np.uint64)) for _ in range(2))
    assert jaccard_join.differing(jaccard_join.digest(a), jaccard_join.digest(b)) > 1200 and jaccard_join.differing(jaccard_join.digest(a), jaccard_join.digest(a)) == 0


def test_spanning_pairs_tie_the_same_components():
    rng = np.random.default_rng(9)
    for _ in range(30):
        comps = rng.integers(0, 10**9, 50)
        forest, tied, whole = jaccard_join.Forest(comps), [], []
        for _ in range(rng.integers(1, 6)):
            x, y = rng.integers(0, 50, (2, 12))
            kept = forest.ties(comps[x], comps[y])
            whole += zip(comps[x].tolist(), comps[y].tolist())
            tied += zip(comps[x[kept]].tolist(), comps[y[kept]].tolist())

        def least(pairs):
            root = {c: c for c in comps.tolist()}
            for _ in range(50):
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert least(tied) == least(whole) and len(tied) <= 49


def test_a_group_of_near_copies_is_connected_by_few_answers(spark, monkeypatch):
    """Copies that each have one word of their own: some 300 links to a set, fewer answers than twice the sets."""
    rng = np.random.default_rng(4)
    texts = []
    for i in range(300):
        w = [f"w{k}" for k in range(150)]
        w[rng.integers(0, 150)] = f"x{i}"
        texts.append((i, " ".join(w)))
    asked = []
    overlaps = jaccard_join.overlaps
    monkeypatch.setattr(jaccard_join, "overlaps", lambda pairs, docs, width: (asked.append(pairs.count()), overlaps(pairs, docs, width))[1])
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert groups(docs) == brute(texts, 4, 85)
    assert sum(asked) <= 3 * len(texts)


def test_equal_sets_are_listed_once(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{rng.randrange(1000)}" for _ in range(200)]
    other = [f"v{i}" if i % 7 == 0 else w for i, w in enumerate(base)]  # shares shingles, but doesn't link
    rows = [(d, " ".join(base if d % 2 else other)) for d in range(40)]
    rows += [(50, " ".join(base)), (50, " ".join(other + ["x"]))]  # an id with several texts stays
    listed, real = [], jaccard_join.prefixes
    monkeypatch.setattr(jaccard_join, "prefixes", lambda docs, *rest: listed.append(sorted(r["doc_id"] for r in docs.collect())) or real(docs, *rest))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert groups(docs) == brute(rows, 4, 85)
    assert listed == [[0, 1, 50, 50]]


def test_stragglers_of_a_group_are_asked_against_their_likeliest_links(spark, monkeypatch):
    """Copies with one to six changed words: those at the edge of the group look like others at the edge, but link elsewhere."""
    rng = np.random.default_rng(6)
    texts = []
    for i in range(200):
        w = [f"w{k}" for k in range(400)]
        for k in range(rng.integers(1, 7)):
            w[rng.integers(0, 400)] = f"x{i}y{k}"
        texts.append((i, " ".join(w)))
    rows, stored = {}, jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda frame, name: (out := stored(frame, name), rows.update({name: out.count()}))[0])
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    assert groups(docs) == brute(texts, 4, 85)
    assert rows["open-pairs"] <= 40


def test_linked_sets_share_the_least_number_of_lists():
    rng = np.random.default_rng(8)
    order, linked = jaccard_join.Order.of(np.arange(0, 900, 7), rng.integers(1, 50, 129)), 0
    for _ in range(600):
        a = np.unique(rng.integers(0, 5000, rng.integers(3, 400))).astype(np.uint64)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.85, 1)], rng.integers(0, 5000, rng.integers(0, len(a) // 6 + 1)).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            linked += 1
            assert len(np.intersect1d(order.prefix(a, 85), order.prefix(b, 85))) >= jaccard_join.least_shared(len(a), len(b), 85) >= 1
    assert linked > 200 and jaccard_join.least_shared(2000, 2000, 85) > 130


def test_a_task_names_a_pair_once():
    pairs = [(np.array([5, 1, 5]), np.array([7, 2, 7]), np.array([False, False, True]), np.ones(3, dtype=int), np.array([4, 1, 4])),
             (np.array([5, 5]), np.array([7, 6]), np.array([False, False]), np.array([2, 1]), np.array([4, 0]))]
    got = list(zip(*[c.tolist() for c in jaccard_join.counted(pairs)]))
    assert got == [(1, 2, False, 1, 1), (5, 6, False, 1, 0), (5, 7, True, 4, 4)]
