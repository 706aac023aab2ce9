"""The filter audit against plain Python: hard texts, ties, tries that are emptied early, and cuts of shared prefixes."""

import re
from collections import Counter
from itertools import permutations

import pytest

from lettrage.llm import filter_audit
from lettrage.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, mask string, part int, n long"


def failing(text, copy):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return (
        "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        + "D" * bool(re.search(r"[#$%&*|]", text)) + "E" * copy
    )


def brute(rows, labels):
    rows = [(d, t or "", lang or "") for d, t, lang in rows]
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    judged = [(lang, failing(t, d is not None and least[t] < d), d in good, d in toxic) for d, t, lang in rows]
    out = {}
    for part in {j[0] for j in judged}:
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = [j for j in judged if j[0] == part]
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(gone)
                all_fail = sum(f in j[1] for j in judged if j[0] == part)
                out[part, order, step] = [
                    len(left), len(gone), all_fail - len(gone), sum(j[1] == f for j in judged if j[0] == part), sum(j[2] for j in gone), sum(j[3] for j in gone), f
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 5, 7) for r in rows], SCHEMA).repartition(5)
    marks = spark.createDataFrame([(*r, "clash") for r in labels], "doc_id long, quality int, toxic int, text string")
    report = filter_audit.audit(filter_audit.failures(docs), marks).collect()
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in report}
    assert len(got) == len(report)
    return got


def hard_rows():
    long = "one long text of words " * 20_000
    plain = " ".join(f"word{i}" for i in range(150))
    rows = [(i, "the same text in a third of all rows", ["en", "de", None, ""][i % 4]) for i in range(0, 120, 2)]
    rows += [(1, plain, "en"), (3, plain + " ", "en"), (5, plain, None), (7, plain[:-1], "fr"), (9, plain.upper(), "fr"), (11, plain + " #", "fr")]
    rows += [(13, None, "en"), (15, "", "en"), (17, "", None), (19, None, None), (21, " \n\t\x0b\x0c\r ", "en"), (23, "É" * 9 + "A", "en"), (25, "É" * 10 + "A", "en")]
    rows += [(27, long, "en"), (29, long, "en"), (28, long + "x", "en"), (None, plain, "en"), (None, None, None), (None, plain, "en")]
    rows += [(31, "twice the same row", "en")] * 3 + [(31, "twice the same row", "de"), (30, "twice the same row", "de"), (32, "nul \x00 byte", "en")]
    return rows


LABELS = [(i, i % 3 % 2, i % 2) for i in range(0, 40)] + [(4, 1, None), (5, None, None), (None, 1, 1), (7, 0, 1), (7, 1, 0), (999, 1, 1)]


@pytest.mark.parametrize("task_bytes", [16 << 20, 50])
def test_audit_of_hard_texts(spark, monkeypatch, task_bytes):
    monkeypatch.setattr(filter_audit, "TASK_BYTES", task_bytes)
    assert audited(spark, hard_rows(), LABELS) == brute(hard_rows(), LABELS)


def test_empty_tables(spark):
    assert audited(spark, [], LABELS) == {}
    rows = hard_rows()[:9]
    assert audited(spark, rows, []) == brute(rows, [])


def test_given_tables_give_every_order(spark, sf):
    report = QUERIES["op11_filter_audit"](spark, sf)
    rows = report.collect()
    assert len(rows) == 600 * len({r["part"] for r in rows}) and len({r["filter_order"] for r in rows}) == 120


def test_tries_keep_the_least_id_and_share_prefixes():
    trie = filter_audit.Trie()
    texts = [b"", b"a", b"ab", b"abc", b"abd", b"b" * 5000, b"b" * 5000 + b"c", b"b" * 4999 + b"x", "é".encode(), "è".encode()]
    decided = []
    for order in (5, 3, 8, 3):
        for text in texts:
            decided += trie.insert(text, order, 8, "p", 1)
    walked = list(trie.walk())
    assert [w[0] for w in walked] == sorted(texts) and all(w[1:] == (3, 8, {"p": 2}) for w in walked)
    assert sorted(decided) == sorted([(5, "p", 24, 1), (8, "p", 24, 1)] * len(texts))
    assert trie.bytes == sum(map(len, texts))


def test_prefixes_grow_where_texts_begin_alike(spark):
    head = "a head that a great many texts share, longer than one step " * 3
    docs = spark.createDataFrame([(head + f"{i:04}",) for i in range(400)] + [(f"{i:04} other",) for i in range(100)], "text string")
    cuts = filter_audit.prefix_cuts(docs, 10, 500)
    assert cuts == sorted(set(cuts)) and 5 <= len(cuts) <= 9
    sizes = Counter()
    for (text,) in docs.collect():
        sizes[filter_audit.bisect_right(cuts, text.encode())] += len(text) + 1
    assert max(sizes.values()) <= 1.2 * sum(sizes.values()) / 10
    same = spark.createDataFrame([("x" * 300,)] * 50, "text string")
    assert len(filter_audit.prefix_cuts(same, 10, 50)) <= 1


def test_the_task_phase_sends_one_row_of_a_hot_text():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array(["hot " * 50] * 5000), pa.array(["en"] * 5000)], names=["doc_id", "text", "part"])
    sent = pa.Table.from_batches(filter_audit.within_tasks([], 4)([batch]))
    assert sent.num_rows == 5000 and sent.column("text").null_count == 4999
