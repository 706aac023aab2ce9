"""The pipeline against plain Python, stage by stage, and what it leaves alone."""

import brute
from test_chat_and_lines import dedup, sha
from test_decontaminate import brute as leaks_of
from test_jaccard_join import brute as groups_of

import corpus_pipeline
from lettrage.llm.shared import stored

assert brute


def test_stages(spark, tmp_path):
    words = lambda seed, n: " ".join(f"mot{(seed * 7919 + i * 104729) % 5003}" for i in range(n))
    item = words(999, 40)
    short = lambda seed, n: words(seed, n).replace(" ", "\n")  # noqa: E731  lines that line dedup leaves
    rows = [(i, short(i, 60 + i), "en", 1) for i in range(12)]
    rows += [(20, short(3, 63), "en", 2), (21, short(3, 62) + " un", "en", 3), (22, None, "en", 0), (23, "12 34 !!", "de", 8), (24, "", None, 0)]
    rows += [(25, f"before {item} after " + words(25, 30), "en", 5), (26, words(26, 30) + "\nune ligne qui revient\n", "en", 5), (27, words(27, 30) + "\nUne ligne qui revient\n", "en", 5)]
    rows += [(None, words(77, 50), "en", 9), (28, words(28, 40), None, None)]
    docs = spark.createDataFrame([r + (7,) for r in rows], "doc_id long, text string, lang string, n_chars long, component_id int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, frames = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in frames.collect()] if name != "language" else [(r[0], r[1]) for r in rows]
        kinds = frames.dtypes
        frames = stored(stage(spark, frames, str(tmp_path)), name)
        seen[name] = before
        if name != "packing":
            assert frames.dtypes == kinds
        after = sorted(((r["doc_id"], r["text"]) for r in frames.collect()), key=str) if name != "packing" else frames.collect()
        if name == "language":
            assert {d for d, _ in after} == {d for d, *_ in rows} - {22, 23, 24}
        elif name == "line_dedup":
            assert [(d, sha(t)) for d, t in after] == sorted(((d, kept) for d, _, _, kept in dedup(before)), key=lambda r: str((r[0], dict(after)[r[0]])))
            assert dict(after)[27] == words(27, 30) + "\n" and dict(after)[26] == dict(before)[26]
        elif name == "near_duplicates":
            gone = {key[1] for key, _, least in groups_of(before, 5, 80) if key[0] and least != key[1]}
            assert gone == {20, 21} and {d for d, _ in after} == {d for d, _ in before} - gone
        elif name == "decontamination":
            assert {d for d, _ in leaks_of(before, [(1, item)])} == {25} and {d for d, _ in after} == {d for d, _ in before} - {25}
        else:
            assert {r["doc_id"] for r in after} == {d for d, _ in before}
    assert sorted(map(str, frames.collect())) == sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect()))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_names_repeated_rows_and_a_very_long_text(spark, tmp_path):
    words = lambda seed, n: " ".join(f"mot{(seed * 7919 + i * 104729) % 500_009}" for i in range(n))
    rows = [(1, words(1, 60)), (2, words(1, 60) + " un"), (3, words(3, 60)), (3, words(3, 60)), (4, words(4, 150_000)), (5, "12 34")]
    docs = spark.createDataFrame([(d, t, "en", d, 7, "x") for d, t in rows], "doc_id long, text string, lang string, rejected_doc_id long, rejected_body long, body string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "of no document")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == {1, 3, 4} and sum(r["doc_id"] == 3 for r in pieces) == 2
    assert sum(r["length"] for r in pieces if r["doc_id"] == 4) == next(r["doc_tokens"] for r in pieces if r["doc_id"] == 4) > 150_000
