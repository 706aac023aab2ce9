"""License scans against plain Python, and licence expressions by value."""

import re

import pytest

from lettrage.llm import license_scan as ls
from lettrage.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def brute(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places = [(i, label) for i in range(len(words)) for p, label in BASE.items() if tuple(words[i : i + len(p)]) == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in places}))


TEXTS = [
    None, "", "MIT License", "mit-license", "MIT\n\nLicense mit license MIT license", "mitlicense", "emit license", "mit licenses", "the GNU General Public License v3",
    "general public general public license", "Émit license", "mit é license", "mit\x00license", "MIT_License", "apache license, apache2 license", "x" * 50_000,
    "mit license " * 20_000, "SPDX-License-Identifier: MIT", "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nrest", "汉字 mit license 汉字",
    "ſpdx mit ſ license K", "GNU Lesser General Public License", "SPDX-License-Identifier: " * 3000, "SPDX-License-Identifier: mit or " * 3000,
]


def test_base_of_hard_texts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "mit license")] * 2 + [(None, "apache license")]
    docs = spark.createDataFrame([(d, t, "clash", 0.5) for d, t in rows], "doc_id long, text string, labels string, score double").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in ls.digests(ls.find_licenses(docs)).collect()), key=repr)
    assert got == sorted(((d, *brute(t)) for d, t in rows), key=repr)
    for r in ls.digests(ls.find_licenses(docs)).collect():
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] > 0) == (r["labels"] != "")
    assert ls.find_licenses(docs.filter("false")).count() == 0


def test_query_over_the_given_table(spark, sf, table):
    got = {r["doc_id"]: tuple(r)[1:6] for r in QUERIES["op13_license_scan"](spark, sf).collect()}
    want = {r["doc_id"]: brute(r["text"]) for r in table("documents").collect()}
    assert got == want and any(w[1] for w in want.values())


@pytest.mark.parametrize("text, labels, duties", [
    ("mit", {"mit"}, 1), ("gpl-3.0-only", {"gpl"}, 3), ("mit or gpl-2.0", {"mit", "gpl"}, 1), ("mit and gpl-2.0", {"mit", "gpl"}, 3),
    ("mit or gpl-2.0 and mpl-2.0", {"mit", "gpl", "mpl"}, 1), ("(mit or gpl-2.0) and mpl-2.0", {"mit", "gpl", "mpl"}, 2),
    ("gpl-2.0 with classpath-exception-2.0", {"gpl"}, 2), ("gpl-2.0 with some-exception or agpl-3.0", {"gpl", "agpl"}, 2),
    ("((mit))", {"mit"}, 1), ("unlicense or foo-1.0", {"unlicense", "other"}, 0), ("mitre", {"other"}, 4), ("mit gpl", {"mit"}, 1), ("mit) or gpl", {"mit"}, 1),
])
def test_expressions(text, labels, duties):
    assert ls.evaluate(text)[0] == (labels, duties)


@pytest.mark.parametrize("text", ["", "or mit", "mit or", "(mit", "()", "mit and or gpl", "with", "mit or (gpl and", "-"])
def test_broken_expressions(text):
    assert ls.evaluate(text)[0] is None


def test_long_expressions_and_nesting():
    assert ls.evaluate(" or ".join(["gpl"] * 50_000 + ["mit"]))[0] == ({"gpl", "mit"}, 1)
    assert ls.evaluate("(" * 20_000 + "mit" + ")" * 20_000)[0] == ({"mit"}, 1)


def test_tags_places_and_extra_phrases(spark):
    text = "é SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\nLicense-Expression: nothing or\nUnder the House License and the House License."
    row = ls.find_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"), {"house license": "house"}).first()
    assert [(e["text"], e["valid"], e["labels"]) for e in row["expressions"]] == [("apache-2.0 with llvm-exception", True, ["apache"]), ("nothing or", False, [])]
    assert [text[e["start"] :][:4] for e in row["expressions"]] == [" Apa", " not"]
    assert [(p["label"], p["kind"]) for p in row["places"]] == [("house", "name")] * 2 and row["labels"] == ["apache", "house"]
    assert row["score"] == round(1 - 0.05 * 0.4, 6)
