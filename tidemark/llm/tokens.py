"""Token ids of whole texts, with a word cache around a public tokenizer.

The vocabulary's normaliser and pre-tokenizer never look across a blank or a
line end, nor from a letter to the closing punctuation of its word, so a text's ids are the
ids of these units in order. Every unit the task has not met goes through the ``tokenizers``
library, many at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np

#: Units that a Python worker keeps before it starts afresh. They bound its memory to about 200 MB and never change ids.
CACHE_WORDS = 1_200_000
#: Characters of texts whose new words are learnt together.
TOGETHER = 1 << 20
#: The marker that a special token's text starts with, and the mark of a word's last token.
SPECIAL = "<|"
WORD_END = "</w>"

_LETTERS, _CLOSING = "a-zß-öø-ÿ", ".,;:!?"
#: Letters only, or closing punctuation only.
_PLAIN = re.compile(f"[{_LETTERS}]+|[{_CLOSING}]+")
#: Closing punctuation between a letter and the end of its word.
_TAIL = re.compile(f"([{_CLOSING}])(?<=[{_LETTERS}][{_CLOSING}])([{_CLOSING}]*)(?=[ \\n]|\\Z)")
_CODERS: dict[str, "Coder"] = {}


class Coder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.words: dict[str, bytes] = {"": b""}

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; units that none of them had before are learnt together."""
        rows = [None if SPECIAL in t else _TAIL.sub(r" \1\2", self.lowered(t)).replace("\n", " ").split(" ") for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        self.learn(set().union(*(r for r in rows if r)).difference(self.words))
        known = self.words.__getitem__
        for text, words in zip(texts, rows, strict=True):
            yield self.direct(text) if words is None else b"".join(map(known, words))

    @staticmethod
    def lowered(text: str) -> str:
        """Lower case ahead of the library, where that cannot change its result."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text.lower()

    def direct(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, new: set[str]) -> None:
        """Plain units go through the library as one text: each is one word to it, so its last token is marked."""
        plain = list(filter(_PLAIN.fullmatch, new))
        others = list(new.difference(plain))
        if plain:
            ids = np.frombuffer(self.direct(" ".join(plain)), dtype="<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) != len(plain):
                raise ValueError("the tokenizer split a plain word; it does not fit the word cache")
            raw = ids.tobytes()
            self.words.update(zip(plain, [raw[4 * a:4 * b] for a, b in zip([0, *stops], stops)]))
        found = self.library.encode_batch(others, add_special_tokens=False)
        self.words.update([(word, np.array(e.ids, dtype="<u4").tobytes()) for word, e in zip(others, found, strict=True)])


def coder(path: str) -> Coder:
    """The worker's coder for a vocabulary file, loaded once."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encoded(texts: Iterable[str | None], path: str, end_id: int | None) -> Iterator[bytes]:
    """Ids of each text (null: empty), with the end id appended."""
    last = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    work = coder(path)
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= TOGETHER:
            yield from (ids + last for ids in work.encode_all(held))
            held, size = [], 0
    yield from (ids + last for ids in work.encode_all(held))
