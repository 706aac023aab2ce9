"""License scans: phrases and tags by Aho-Corasick, licence expressions by a shunting yard.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. One automaton walks the words of a text,
joined by single blanks, and finds every place where the words of a phrase stand one after another. A second one walks the
text itself and finds identifier tags. What follows a tag on its line is read as an expression of identifiers, ``and``,
``or``, ``with`` and parentheses: a shunting yard orders the operators (``with`` before ``and`` before ``or``) and evaluates
them at once to the labels named and the least of duties that a licensee can choose.

The score is 1 less the product of the doubts of all distinct pieces of evidence: a phrase leaves ``DOUBT`` of its kind, a
tag with a known identifier 0.05, a tag with unknown ones only 0.5.

Defined cases: null text is empty and has no words, no labels and score 0; a phrase counts at every place, places of one
phrase may share words; a tag without a valid expression gives an expression marked invalid and no label; identifiers that
aren't known give the label ``other``; repeated rows come as often as they occur; an empty table gives no rows; other
columns are left behind. A very long text is one row, its memory grows with its places, not with pairs of them.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettrage.llm.shared import documents

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Words of well-known notices and names of licences, and what they name.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
NAMES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "european union public licence": "eupl", "bsd license": "bsd", "isc license": "isc", "zlib license": "zlib", "boost software license": "bsl",
    "mit licence": "mit", "apache licence": "apache", "general public licence": "gpl", "creative commons attribution": "cc-by",
    "creative commons zero": "cc0", "all rights reserved": "reserved",
}
TAGS = ("spdx-license-identifier:", "license-identifier:", "license-expression:", "licence-expression:")
# How identifiers of an expression begin, the label they have, and the duties of a licensee from 0 to 4.
IDENTIFIERS = {
    "mit": ("mit", 1), "apache": ("apache", 1), "agpl": ("agpl", 4), "lgpl": ("lgpl", 2), "gpl": ("gpl", 3), "bsd": ("bsd", 1), "isc": ("isc", 1),
    "mpl": ("mpl", 2), "epl": ("epl", 2), "eupl": ("eupl", 3), "zlib": ("zlib", 1), "bsl": ("bsl", 1), "unlicense": ("unlicense", 0), "cc0": ("cc0", 0),
    "cc-by": ("cc-by", 1),
}
OTHER = ("other", 4)
DOUBT = {"base": 0.25, "notice": 0.1, "name": 0.4}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
KNOWN = sorted(IDENTIFIERS, key=len, reverse=True)

UPPER = bytes(range(65, 91))
LOWERED = bytes.maketrans(UPPER, UPPER.lower())
WORDED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SYMBOL = re.compile(r"[()]|[a-z0-9][a-z0-9.+:-]*")
FOUND = (
    "doc_id bigint, n_words bigint, places array<struct<word:bigint,kind:string,label:string,phrase:string>>, "
    "expressions array<struct<start:bigint,text:string,valid:boolean,labels:array<string>,duties:int>>, labels array<string>, score double"
)


def identifier(name: str) -> tuple[frozenset[str], int]:
    """The label and duties of an identifier: those of the longest known beginning that ends at a mark or a digit."""
    for known in KNOWN:
        if name.startswith(known) and not name[len(known) : len(known) + 1].isalpha():
            label, duties = IDENTIFIERS[known]
            return frozenset([label]), duties
    return frozenset([OTHER[0]]), OTHER[1]


def applied(operator: str, left: tuple, right: tuple) -> tuple[frozenset[str], int]:
    """Of a choice the lesser duties hold, of both the greater; an exception takes one duty off a licence that has several."""
    if operator == "with":
        return left[0], max(1, left[1] - 1) if left[1] > 1 else left[1]
    return left[0] | right[0], min(left[1], right[1]) if operator == "or" else max(left[1], right[1])


def evaluate(text: str) -> tuple[tuple[frozenset[str], int] | None, int]:
    """Labels and duties of the expression at the start of ``text`` (lower case), None if there is none, and where it ends:
    where two identifiers would follow one another, or a parenthesis closes that wasn't opened."""
    values: list[tuple] = []
    waiting: list[str] = []
    wants_value, opened, end = True, 0, 0

    def settle(least: int) -> None:
        while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= least:
            right = values.pop()
            values.append(applied(waiting.pop(), values.pop(), right))

    for match in SYMBOL.finditer(text):
        symbol = match[0]
        if wants_value:
            if symbol == ")" or symbol in PRECEDENCE:
                return None, end
            if symbol == "(":
                waiting.append(symbol)
                opened += 1
            else:
                values.append(identifier(symbol))
                wants_value = False
        elif symbol in PRECEDENCE:
            settle(PRECEDENCE[symbol])
            waiting.append(symbol)
            wants_value = True
        elif symbol == ")" and opened:
            settle(0)
            waiting.pop()
            opened -= 1
        else:
            break
        end = match.end()
    if wants_value or opened:
        return None, end
    settle(0)
    return values[0], end


class Scanner:
    """Both automata. ``extra`` has further phrases and their labels."""

    def __init__(self, extra: dict[str, str] | None = None):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        kinds = (("base", BASE), ("notice", NOTICES), ("name", NAMES | (extra or {})))
        for kind, listed in kinds:
            for phrase, label in listed.items():
                self.phrases.add_word(f" {phrase} ", (kind, label, phrase))
        for tag in TAGS:
            self.tags.add_word(tag, len(tag))
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def places(self, words: list[bytes]) -> list[tuple[int, str, str, str]]:
        """(first word, kind, label, phrase) of all phrases, by place."""
        joined = b" " + b" ".join(words) + b" "
        hits = [(end - len(found[2]) - 1, found) for end, found in self.phrases.iter(joined.decode("latin-1"))]
        if not hits:
            return []
        blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        at = np.searchsorted(blanks, [start for start, _ in hits]).tolist()
        return sorted((word, *found) for word, (_, found) in zip(at, hits))

    def expressions(self, raw: bytes) -> list[tuple[int, str, tuple | None]]:
        """(character where it starts, text, value) of the expressions behind tags. One ends before the next tag at the latest,
        so that a line full of tags is read once."""
        lowered = raw.translate(LOWERED)
        tags = {end + 1: end + 1 - size for end, size in self.tags.iter(lowered.decode("latin-1"))}
        starts, found, met, place = sorted(tags), [], 0, 0
        for start, following in zip(starts, [*starts[1:], None]):
            line = lowered.find(b"\n", start)
            stops = [stop for stop in (line if line >= 0 else len(raw), tags.get(following)) if stop is not None]
            text = lowered[start : max(start, min(stops))].decode("utf-8", "ignore")
            value, end = evaluate(text)
            place += len(raw[met:start].decode("utf-8", "ignore"))
            met = start
            found.append((place, text[:end].strip(), value))
        return found

    def scan(self, raw: bytes) -> tuple:
        """n_words, places, expressions, labels and score of a UTF-8 text."""
        words = raw.translate(WORDED).split()
        places, read = self.places(words), self.expressions(raw)
        labels = {label for _, _, label, _ in places}
        doubts = {(kind, phrase): DOUBT[kind] for _, kind, _, phrase in places}
        expressions = []
        for start, text, value in read:
            named = sorted(value[0]) if value else []
            labels.update(named)
            if value:
                doubts["tag", text] = 0.5 if named == [OTHER[0]] else 0.05
            expressions.append({"start": start, "text": text, "valid": value is not None, "labels": named, "duties": value[1] if value else None})
        doubt = 1.0
        for key in sorted(doubts):
            doubt *= doubts[key]
        return len(words), [dict(zip(("word", "kind", "label", "phrase"), p)) for p in places], expressions, sorted(labels), round(1.0 - doubt, 6)


ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("places", pa.list_(pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string()), ("phrase", pa.string())]))),
    ("expressions", pa.list_(pa.struct([
        ("start", pa.int64()), ("text", pa.string()), ("valid", pa.bool_()), ("labels", pa.list_(pa.string())), ("duties", pa.int32()),
    ]))),
    ("labels", pa.list_(pa.string())), ("score", pa.float64()),
])


def find_licenses(docs: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, n_words, places, expressions, labels, score`` of every document."""

    def scan(batches):
        scanner = Scanner(extra)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [scanner.scan(raw) for raw in part.column(1).cast(pa.binary()).to_pylist()]
                columns = [part.column(0), *[pa.array(c, f.type) for c, f in zip(zip(*found), list(ARROW)[1:])]]
                yield pa.RecordBatch.from_arrays(columns, schema=ARROW)

    return documents(docs).mapInArrow(scan, FOUND)


def digests(found: DataFrame) -> DataFrame:
    """Counts and places of the base phrases beside all labels."""
    base = found.withColumn("base", F.filter("places", lambda p: p["kind"] == "base"))
    return base.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"), F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )
