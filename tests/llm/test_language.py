"""Language identification: held-out accuracy, defined cases, filters."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lettrage.llm import language
from lettrage.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_language"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = rows.filter("held_out and lang is not null").agg(F.count("*").alias("n"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert held["n"] > 100 and held["right"] > 0.97
    assert rows.count() == 1000 and rows.filter("score < 0 or score > 1 or score is null").count() == 0


def test_defined_cases(spark):
    rows = [(1, "the quick brown fox", "en", 1), (2, "der schnelle braune Fuchs", "de", 1), (3, None, "en", 1), (4, "12 !! 34", "de", 1), (5, "", None, 1),
            (6, "x", "en", 1), (7, "the brown dog " * 4000, None, 1), (None, "der braune", "de", 1), (7, "the", "en", 1)]
    docs = spark.createDataFrame([r + (0.5,) for r in rows * 3], "doc_id long, text string, lang string, known int, score double")
    filters = language.fit(docs)
    got = {}
    for r in language.predict(docs, filters).collect():
        got.setdefault(r["doc_id"], set()).add(r["lang_pred"])
    assert got[3] == got[4] == got[5] == {"und"} and got[7] == {"en"} and got[None] == {"de"} and got[1] == {"en"} and got[2] == {"de"}
    empty = docs.filter("false")
    assert language.predict(empty, filters).count() == 0
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(empty)).collect()} == {"und"}


def test_filters_hold_every_window():
    keys = np.arange(50_000, dtype=np.uint32) * 7919
    filters = language.Filters.build({"a": keys[:30_000], "b": keys[20_000:]}, {"a": 1, "b": 1})
    masks = None
    for places in language.hashes(keys):
        masks = filters.slots[places, 0] if masks is None else masks & filters.slots[places, 0]
    assert (masks[:30_000] & 1).all() and (masks[20_000:] & 2).all()
    false = (masks[30_000:] & 1).mean()
    assert false < 0.01 and abs(false - filters.rates[0]) < 0.005
    sizes, counts = filters.count([keys[:100].tobytes(), b""])
    assert sizes.tolist() == [401, 1] and counts.shape == (2, 2)


def test_many_languages():
    filters = language.Filters.build({f"l{i:03d}": np.array([i * 977], dtype=np.uint32) for i in range(70)}, {f"l{i:03d}": 1 for i in range(70)})
    assert filters.slots.shape[1] == 2
    assert filters.count([np.array([69 * 977], dtype="<u4").tobytes()])[1].argmax() == 69


def python_hashes(key):
    mixed = key ^ (key >> 15)
    shift = 32 - language.SLOTS.bit_length() + 1
    return [((mixed * m) & 0xFFFFFFFF) >> shift for m in language.MULTIPLIERS[: language.HASHES]]


def python_windows(text):
    raw = b" " + text.lower().encode() + b"    "
    return [int.from_bytes(raw[i : i + 4], "little") for i in range(len(raw) - 4)]


def brute(learned, asked):
    """Windows, filters and their counts as plain sets and integers; ``learned`` rows are (text, language)."""
    counts = {}
    for text, name in learned:
        if text is not None and name is not None:
            counts.setdefault(name, Counter()).update(python_windows(text))
    shares = {name: {w: n / sum(c.values()) for w, n in c.items() if n >= language.LEAST} for name, c in counts.items()}
    most = Counter()
    for found in shares.values():
        for w, share in found.items():
            most[w] = max(most[w], share)
    filters = {}
    for name, found in shares.items():
        kept = sorted((-s, w) for w, s in found.items() if s >= language.RATIO * most[w])[: language.TYPICAL]
        filters[name] = {place for _, w in kept for place in python_hashes(w)}
    rates = {name: (len(places) / language.SLOTS) ** language.HASHES for name, places in filters.items()}
    out = []
    for text in asked:
        if text is None or not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        windows, found = [python_hashes(w) for w in python_windows(text)], {}
        for name, places in filters.items():
            hits = sum(all(p in places for p in w) for w in windows)
            found[name] = max((hits - len(windows) * rates[name]) / (1 - rates[name]), 0.0)
        best = min(found, key=lambda name: (-found[name], name))
        out.append((best, found[best] / sum(found.values())))
    return out


def test_predictions_against_plain_sets(spark, table):
    rows = [(r["doc_id"], r["text"][:3000], r["lang"]) for r in table("documents").orderBy("doc_id").limit(60).collect()]
    rows += [(1001, None, "en"), (1002, "", "fr"), (1003, "12", "de"), (1004, "Été ÉTÉ ñandú", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, language.fit(docs)).collect()}
    want = dict(zip([r[0] for r in rows], brute([r[1:] for r in rows], [r[1] for r in rows])))
    assert {d: w[0] for d, w in got.items()} == {d: w[0] for d, w in want.items()}
    assert all(abs(got[d][1] - want[d][1]) < 1e-9 for d in want)


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(i, "same words in both", name) for i, name in enumerate(["zz", "aa"] * 5)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(docs)).collect()} == {"aa"}
