"""Token files and packing against the tokenizers library on whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lettrage.llm import huffman, packing, token_files
from lettrage.llm.tokens import Pieces, default_vocabulary

HARD = [
    (5, None), (3, ""), (3, "a"), (9, "Été́  x\x1cy \tz\r\nq<|endoftext|> don't I'LL 12３４ ﬁ"), (None, "no id"), (1, "word " * 3000),
    (2, "\n \n"), (8, "x" * 500), (7, "汉字 カタカナ é ́a  --- !!!"), (7, "a"), (11, "Word, word. WORD.. .word word.,x a1. , É.%% ÀÉ!? ª² x² straße, İx. ŉ don't'"),
]


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_vocabulary())
    return [(d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")) for d, t in rows]


@pytest.fixture(scope="module")
def hard(spark):
    return spark.createDataFrame([(d, t, 1, 2) for d, t in HARD], "doc_id long, text string, length int, start int").repartition(3)


def rows_of(table):
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=400), st.integers(1, 70))
def test_code_round_trip(ids, every):
    ids = np.array(ids, dtype=np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=401) ** 4)
    code = huffman.Code.canonical(lengths)
    parts = np.split(ids, [len(ids) // 3, len(ids) // 2])
    streams, offsets = zip(*[code.encode(p, every) for p in parts])
    back = code.decode(b"".join(streams), np.concatenate(offsets), np.array([len(b) for b in streams]), np.array([len(p) for p in parts]), every)
    assert back.tolist() == ids.tolist()


def test_lengths_are_limited_and_optimal():
    assert huffman.code_lengths(np.array([5, 9, 12, 13, 16, 45])).tolist() == [4, 4, 3, 3, 3, 1]
    counts = np.array([int(1.7**k) for k in range(1, 60)])
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= 16 and sum(2.0 ** -int(x) for x in lengths) == 1.0
    assert huffman.code_lengths(np.array([0, 0, 3])).tolist() == [0, 0, 1] and huffman.code_lengths(np.zeros(3, int)).sum() == 0


def test_pieces_equal_whole_texts(table):
    rows = rows_of(table("documents"))[:60] + HARD
    pieces = Pieces(default_vocabulary())
    assert pieces.encode([t for _, t in rows]) == [ids.tobytes() for _, ids in expected(rows)]
    assert [pieces.encode([t])[0] for _, t in rows] == [ids.tobytes() for _, ids in expected(rows)]


def check_files(docs):
    want, start = [], 0
    key = lambda r: (r[0] is not None, r[0] or 0)
    rows = expected(rows_of(docs))
    got = [tuple(r) for r in token_files.round_trip(docs).collect()]
    assert sorted(r[1] for r in got) == [r[1] for r in sorted(got, key=lambda r: (*key(r), r[1]))]
    assert sorted((key(r), r[2], r[3]) for r in got) == sorted((key((d,)), len(i), zlib.crc32(i.tobytes())) for d, i in rows)
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == start
        start += r[2]
    del want


def test_token_files(table, hard):
    check_files(table("documents"))
    check_files(hard)
    assert token_files.round_trip(hard.filter("false")).count() == 0


def test_packing(table, hard):
    for docs, worst in ((table("documents"), 0.03), (hard, 1.0)):
        rows = sorted(((d is not None, d or 0), i.tobytes()) for d, i in expected(rows_of(docs)))
        got = [r.asDict() for r in packing.pack(docs).collect()]
        whole = {}
        for r in got:
            whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        assert sum(r["length"] for r in got) == sum(len(i) // 4 for _, i in rows)
        sequences = {}
        for r in got:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        assert 1 - sum(r["length"] for r in got) / (2048 * len(sequences)) <= worst
        sums = sorted((len(i[k : k + 8192]) // 4, zlib.crc32(i[k : k + 8192]), k // 4, len(i) // 4) for _, i in rows for k in range(0, len(i), 8192))
        assert sums == sorted((r["length"], r["ids_crc32"], r["start"], r["doc_tokens"]) for r in got)
    assert packing.pack(hard.filter("false")).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20))
def test_patterns_place_each_piece_once(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    placed = {}
    for pattern, packs in patterns:
        assert sum(pattern) <= 64
        for length in pattern:
            placed[length] = placed.get(length, 0) + packs
    assert placed == histogram
