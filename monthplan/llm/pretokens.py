"""Encoding whole texts pre-token by pre-token, with the encodings of recent chunks kept while a task runs.

Text is cut at every space that stands between two non-space characters: there the pre-token pattern always starts a
new match, so the chunks can be split and encoded apart. Texts in which white space precedes a space take the pattern
over the whole text. What an encoder is asked for are single pre-tokens, each distinct one once while it is kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import regex

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_MARKS = (".", ",", ";", ":", "!", "?")


class PreTokenEncoder:
    """``encode(texts)`` gives for each text its ids as little-endian unsigned 32-bit bytes.

    ``encode_new`` maps a list of distinct pre-tokens to a list of such bytes. ``keep`` bounds each of the two
    memories (a full one is emptied; results don't depend on it).
    """

    def __init__(self, pattern: str, encode_new: Callable[[list[str]], list[bytes]], keep: int = 500_000):
        self._find = regex.compile(pattern).findall
        self._encode_new = encode_new
        self._keep = keep
        self._tokens: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}  # chunk without its leading space -> ids with it

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        cut = []  # of each text: pre-tokens of its head (or of the whole), its chunks, and their ids as far as known
        missing: set[str] = set()
        heads: set[str] = set()
        known = self._chunks.get
        for text in texts:
            if _SPACE_AFTER_SPACE.search(text):
                head, rest = self._find(text), []
            else:
                first, *rest = text.split(" ")
                head = self._find(first)
            ids = list(map(known, rest))
            if None in ids:
                missing.update(c for c, i in zip(rest, ids, strict=True) if i is None)
            heads.update(head)
            cut.append((head, rest, ids))
        self._learn(missing, heads)
        token, chunk = self._tokens.__getitem__, self._chunks.__getitem__
        out = []
        for head, rest, ids in cut:
            if None in ids:
                ids = [chunk(c) if i is None else i for c, i in zip(rest, ids, strict=True)]
            out.append(b"".join(map(token, head)) + b"".join(ids))
        for kept in (self._tokens, self._chunks):
            if len(kept) > self._keep:
                kept.clear()
        return out

    def forget(self) -> None:
        """Give the memory back: workers outlive tasks and stages."""
        self._tokens.clear()
        self._chunks.clear()

    def _learn(self, chunks: set[str], heads: set[str]) -> None:
        """Learn chunks and pre-tokens. Letters alone are one pre-token with their space, a mark after them another."""
        words, split = {}, {}
        tokens = {t for t in heads if t not in self._tokens}
        for c in chunks:
            if c.isalpha():
                words[c] = " " + c
            elif c[-1:] in _MARKS and c[:-1].isalpha():
                if c[:-1] not in self._chunks:
                    words[c[:-1]] = " " + c[:-1]
                tokens.add(c[-1])
                split[c] = None
            else:
                split[c] = self._find(" " + c)
                tokens.update(split[c])
        new = [t for t in tokens if t not in self._tokens]
        found = self._encode_new([*new, *words.values()])
        self._tokens.update(zip(new, found, strict=False))
        self._chunks.update(zip(words, found[len(new):], strict=True))
        token = self._tokens.__getitem__
        for c, pieces in split.items():
            self._chunks[c] = self._chunks[c[:-1]] + token(c[-1]) if pieces is None else b"".join(map(token, pieces))
