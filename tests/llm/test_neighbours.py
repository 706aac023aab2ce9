"""Neighbours: recall against brute force, defined cases, the curve."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from lettrage.llm import neighbours


def test_curve_visits_neighbouring_cells():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_recall_with_small_blocks(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows.collect()}
    ids = np.array(sorted(x))
    all_ = np.stack([x[i] for i in ids])
    got = {}
    for r in neighbours.search(rows, F.col("vec_id") % 20 == 0, block=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert len(got) == 100
    hits = 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and len({v for _, v, _ in found}) == 20
        assert all(abs(s - x[q] @ x[v]) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda r: (-r[2], r[1]))
        scores = all_ @ x[q]
        scores[ids == q] = -9
        hits += len({v for _, v, _ in found} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits / 2000 >= 0.9


def test_copies_with_small_blocks(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[1::3], x[5:60:6] = x[1], x[0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(7)
    got = {}
    for r in neighbours.search(rows, F.col("vec_id") % 10 == 0, block=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 10))
    copies, hits, others = list(range(1, 3000, 3)), 0, 0
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and found == sorted(found, key=lambda r: (-r[2], r[1])) and q not in {v for _, v, _ in found}
        if q % 3 == 1:
            assert [v for _, v, _ in found] == [c for c in copies if c != q][:20]
        else:
            scores = (x * x[q]).sum(1)
            scores[q] = -9
            hits += len({v for _, v, _ in found} & set(np.lexsort((np.arange(3000), -scores))[:20].tolist()))
            others += 20
    assert hits / others >= 0.9


def test_defined_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
            (7, [0.5, 0.5]), (8, []), (9, [1.0]), (20, [2.0, 0.0]), (0, [1.0, 0.0]), (0, [1.5, 0.0]), (40, None), (None, [1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, i, 3) for i, v in rows], "vec_id long, embedding array<float>, rank long, part int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.search(frame, F.col("vec_id") % 20 == 0, 3).collect())
    assert got == [(0, 1, 20, 2.0), (0, 2, 1, 0.5), (0, 3, 7, 0.5), (20, 1, 0, 2.0), (20, 2, 1, 1.0), (20, 3, 7, 1.0)]
    assert neighbours.search(frame.filter("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_every_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(5)
    rows = [(100 + i, rng.normal(size=2).tolist()) for i in range(40)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(20)] + [(300, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(frame, F.col("vec_id") % 20 == 0, 5).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    vectors = {i: np.array(v) for i, v in rows}
    for q in (100, 120, 200):
        others = sorted((i for i in vectors if i != q and len(vectors[i]) == len(vectors[q])), key=lambda i: (-(vectors[i] @ vectors[q]), i))[:5]
        assert sorted(got[q]) == list(enumerate(others, 1))
    assert set(got) == {100, 120, 200}
