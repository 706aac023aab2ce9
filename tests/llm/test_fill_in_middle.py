"""Fill-in-middle against plain Python, and the round trip over windows of few bytes."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lettrage.llm import fill_in_middle as fim
from lettrage.llm.queries import QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, rate=50, spm=80):
    text, tokens = text or "", TOKEN.findall(text or "")
    h = [int(sha(f"42:{'' if doc_id is None else doc_id}")[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, "plain", n, None, None, text
    if h[3] % 100 < spm:
        return doc_id, "spm", n, len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, "psm", n, len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", " ", "\n\t", "word", " word", "word ", "é汉 \U0001f600 x y\x1cz", "a <P> b", "a <P b> <", "<S", "<M>", "x <", "> y", "< P >", "a\x00b c", "  a\u0085b",
    "one two three four five six seven eight nine ten" * 9, "long text \n" * 30_000, "x" * 100_000,
]


@pytest.mark.parametrize("window, together", [(1 << 20, 4 << 20), (7, 50)])
def test_hard_texts(spark, monkeypatch, window, together):
    monkeypatch.setattr(fim, "TOGETHER", together)
    texts = TEXTS if window > 100 else [t for t in TEXTS if len(t or "") < 1000]
    rows = [(i, texts[i % len(texts)]) for i in range(8 * len(texts))] + [(None, "no id a b c d"), (7, "same id"), (7, "same id"), (-3, "negative id of a text")]
    docs = spark.createDataFrame([(d, t, "clash", 5) for d, t in rows], "doc_id long, text string, form string, h0 int").repartition(3)
    for rate in (50, 100):
        made = fim.to_fill_in_middle(docs, rate=rate)
        got = [tuple(r) for r in fim.restored(made).collect()]
        want = [(*brute(d, t, rate), t or "") for d, t in rows]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fim.restored(fim.to_fill_in_middle(docs.filter("false"))).count() == 0


def test_query_gives_digests(spark, sf, table):
    got = {r["doc_id"]: r for r in QUERIES["op12_fill_in_middle"](spark, sf).collect()}
    docs = table("documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc_id, text in docs:
        _, form, n, p, m, output = brute(doc_id, text)
        r = got[doc_id]
        assert (r["form"], r["n"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == (form, n, p, m, sha(output), sha(text or ""))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab <>PSM\n\té汉", max_size=30), *[st.integers(0, 2**32 - 1)] * 4), min_size=1, max_size=8), st.integers(1, 9))
def test_scatter_and_gather_over_small_windows(rows, window):
    before, fim.WINDOW = fim.WINDOW, window
    try:
        raw = [t.encode() for t, *_ in rows]
        bounds = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        h = [np.array([r[i] for r in rows]) for i in range(1, 5)]
        form, n, head, body, output, out = fim.build(data, bounds, h, 80, 50)
        back, ends = fim.rebuild(output, out, form)
        assert back.tobytes() == data.tobytes() and ends.tolist() == bounds.tolist()
        for i, (text, *hs) in enumerate(rows):
            tokens = TOKEN.findall(text)
            a, b = sorted((hs[0] % (len(tokens) + 1), hs[1] % (len(tokens) + 1)))
            p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
            shown = bytes(output[out[i] : out[i + 1]]).decode()
            assert n[i] == len(tokens) and shown == [text, f"<S>{s}<P>{p}<M>{m}", f"<P>{p}<S>{s}<M>{m}"][form[i]]
            if form[i]:
                assert (head[i], body[i]) == (len(p), len(m))
    finally:
        fim.WINDOW = before
