"""Tokenising inside tasks: the tokenizers library on distinct words, looked up for whole texts.

The vocabulary ``word_bpe_49k.json`` composes and lower-cases text, drops white space and cuts the rest into words, each of
which its model spells by itself. Text of Latin characters needs no composing, so it is lower-cased and cut here, and only
words that a task has not met go to the library's model. Other text is cut at blanks, and pieces with other characters, or
that could hold a special token's name, go to the whole tokenizer. A task keeps the ids of what it has met, up to ``HELD``
bytes, and gives the memory back when it ends.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

from lettrage.llm.shared import release_memory

END_ID = 1
#: Bytes of words and ids that a task keeps, with what Python holds for each; beyond, the table starts anew before the next
#: texts. It bounds memory and has no effect on results.
HELD, EACH = 128 << 20, 190
#: Texts taken from a batch at a time, and characters of a text cut at a time.
TEXTS, WINDOW = 64, 1 << 20
# How the vocabulary's file cuts lower-case text, for the characters of Latin-1.
LETTER, NUMBER, BLANK = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
WORD = re.compile(f"[{LETTER}]+|[{NUMBER}]|'(?:s|t|re|ve|m|ll|d)|[^{LETTER}{NUMBER}{BLANK}]+")
BREAK = re.compile("[ \n]")
SPECIAL = "<|"


def latin(text: str) -> bool:
    """Whether the text is one of Latin-1 without a special token's name."""
    if SPECIAL in text:
        return False
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Known(dict):
    """Lower-case word, or piece of other text, -> its ids as little-endian 32-bit integers; what is new is tokenised when it
    is looked up. The two never meet: a word is of Latin-1, a piece isn't or holds ``SPECIAL``. ``held`` counts bytes."""

    def __init__(self, tokenizer, spelling: dict[int, str]):
        self.whole, self.model, self.spelling, self.held = tokenizer.encode, tokenizer.model.tokenize, spelling, 0

    def __missing__(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            ids = [t.id for t in self.model(part)]
        elif latin(part):
            ids = [t.id for t in self.model(part.translate(self.spelling))]
        else:
            ids = self.whole(part, add_special_tokens=False).ids
        found = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        self.held += EACH + len(part) + len(found)
        return found


class Pieces:
    """The tokenizer of a vocabulary, and what is known of its words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        spelt = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelling = {i: spelt(chr(i))[0][0] for i in range(0x100)}
        self.forget()

    def forget(self) -> None:
        self.known = Known(self.tokenizer, self.spelling)

    def cut(self, text: str) -> list[str]:
        """The text's words and pieces in order."""
        if latin(text):
            return WORD.findall(text.lower())
        parts = []
        for piece in text.replace("\n", " ").split(" "):
            parts += WORD.findall(piece.lower()) if latin(piece) else [piece]
        return parts

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id; null is empty."""
        end = END_ID.to_bytes(4, "little")
        return [b"".join(map(self.spelt, windows(t or ""))) + end for t in texts]

    def spelt(self, text: str) -> bytes:
        if self.known.held > HELD:
            self.forget()
        return b"".join(map(self.known.__getitem__, self.cut(text)))


def windows(text: str) -> Iterator[str]:
    """A long text in parts of some ``WINDOW`` characters that end at blanks."""
    start = 0
    while start < len(text):
        found = BREAK.search(text, start + WINDOW)
        stop = found.end() if found else len(text)
        yield text[start:stop]
        start = stop


_LOADED: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The worker's tokenizer for a vocabulary, kept from one task to the next; its table is not."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded(batches, path: str) -> Iterator[tuple]:
    """(doc_id, further columns, ids) of Arrow batches of (doc_id, text, further columns), a few texts at a time. At the end of
    a task its table goes."""
    table = pieces_of(path)
    try:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                doc_ids, texts, *others = [c.to_pylist() for c in batch.slice(start, TEXTS).columns]
                yield from zip(doc_ids, *others, table.encode(texts))
    finally:
        table.forget()
        release_memory()
