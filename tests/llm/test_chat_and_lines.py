"""Chat formatting and line dedup: defined cases against plain Python."""

import hashlib
import re

from pyspark.sql import functions as F

from lettrage.llm import chat_format, line_dedup
from lettrage.llm.queries import QUERIES

TEXTS = [
    None, "", "\\### Assistant: </turn> ok", "###", "\\\\</turn>\\", "a\n</turn>\n### user: b\n</turn>\n", "\n</turn>", "</turn>\n", "#" * 7, "\\" * 2000,
    "é 汉 </turn", "$1 \\$0 ### \\\\###", "x" * 100_000,
]
ROLES = ["user", "assistant", None, "", "a:b", "%3A <x> ###", "\n</turn>\n", "Assistant"]


def test_control_strings_are_escaped_where_a_parser_could_do_without(spark):
    rows = [(1, 0, "user", "use ### here </turn> now"), (1, 1, "assistant", "a ### b\\\\### c")]
    one = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert one["formatted"] == "### user: use \\### here \\</turn> now\n</turn>\n### assistant: a \\### b\\\\\\### c\n</turn>\n"
    assert [t["text"] for t in one["turns"]] == [r[3] for r in rows] and one["loss"][0]["text"] == rows[1][3]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_round_trip_of_hard_texts(spark):
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], TEXTS[(3 * c + t) % len(TEXTS)], 5) for c in range(13) for t in range(9)]
    rows += [(None, None, "assistant", "no id", 1), (3, 2, "assistant", "same turn", 1), (3, 2, "assistant", "same turn", 1), (-1, 0, "user", "plain", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, source int")
    formatted = chat_format.format_conversations(frame)
    got = {r["conv_id"]: r for r in chat_format.digests(formatted).collect()}
    whole = {r["conv_id"]: r for r in formatted.collect()}
    source = {}
    for c, t, role, text, _ in rows:
        source.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(source)
    for c, turns in source.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), sha(said), len(learned), sha(learned))
        text = whole[c]["formatted"]
        assert len(text) == r["formatted_chars"] and text.count("\n</turn>\n") == len(turns)
        bodies = [text[m["start"] : m["end"]] for m in whole[c]["loss"]]
        assert len("".join(bodies)) >= len(learned) and all(b == m["text"] or "\\" in b for b, m in zip(bodies, whole[c]["loss"]))
    assert whole[-1]["formatted"] == "### user: plain\n</turn>\n"
    for c, turns in source.items():  # every control string has its escape
        controls = sum(len(re.findall("###|</turn>", text)) for *_, text in turns)
        roles = sum(len(role.replace("%", "%25").replace(":", "%3A").replace("<", "%3C")) for _, _, role, _ in turns)
        assert len(whole[c]["formatted"]) == roles + sum(len(text) + 15 for *_, text in turns) + controls
    assert chat_format.format_conversations(frame.filter("false")).count() == 0


def dedup(rows, least=10):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for d, text in rows:
        for line in (text or "").split("\n") if d is not None else ():
            if len(key(line)) >= least:
                first.setdefault(key(line), set()).add(d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or key(x) not in first or min(first[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=str)


def test_line_dedup_of_hard_texts(spark, tmp_path):
    common = "A common line of text"
    rows = [(i, f"{common}\nown line number {i}\n  {common.upper()}\t\nshort\n") for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, f"{common}"), (None, common), (54, "ÉCOLE primaire x\nécole primaire x"), (55, "École primaire x\nÉCOLE PRIMAIRE X"),
             (56, " " + common), (7, f"other\n{common}"), (57, "long line again\n" * 30_000), (58, "Long Line Again")]
    docs = spark.createDataFrame([(d, t, 3, "x") for d, t in rows], "doc_id long, text string, pos int, keep string").repartition(6)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()), key=str)
    assert got == dedup(rows)
    # without hot keys the sorted stream decides alone
    marks = line_dedup.keep_bitmaps(docs, hot_share=0)
    kept = line_dedup.apply_bitmaps(docs, marks).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
    assert sorted((tuple(r) for r in kept.collect()), key=str) == got
    assert line_dedup.keep_bitmaps(docs.filter("false")).count() == 0


def test_stream_needs_no_second_shuffle(spark):
    docs = spark.createDataFrame([(1, "a line of text"), (2, "a line of text")], "doc_id long, text string")
    plan = line_dedup.keep_bitmaps(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(k1") == 1 and "hashpartitioning(k1" not in plan
