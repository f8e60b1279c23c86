"""Hierarchical multi-length packing of token documents.

Every task tokenises its documents and packs them as they come, in memory bounded by its pools:

1. a document gives full windows of the longest tier; what remains is routed to the shortest tier that holds it,
2. a tier's pool is packed into windows of the tier's length, longest piece first,
3. a gap is filled with whole pieces of the same or shorter tiers, longest that fits first, and closed exactly by
   cutting a piece, so a window of a tier has no padding,
4. the last pieces of a task, less than one window, go into windows of falling powers of two,
5. finished windows go to the lightest of the open step groups, by a cost of tokens plus attention.

Windows never mix tasks, so there is no shuffle, no hot key, and a lost task is simply run again.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .pretokens import PreTokenEncoder
from .tables import id_text, read_table, text_pieces

TIERS = (256, 512, 1024, 2048)
POOL_WINDOWS = 64  # a tier is packed when its pool holds this many windows' tokens
STEP_TOKENS = 64 * 2048
OPEN_GROUPS = 8
EOS = 1

_LONG_RUN = re.compile(r"\S{1000}|\s{1000}")

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
          " sequence_length long, step_group long")
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def merge_ranks(model: dict, pre_tokenizer: dict | None, normalizer: dict | None) -> dict[bytes, int] | None:
    """Bytes -> id of a byte-level BPE whose merges are in the order of the ids they make, else None.

    Such a model merges by rank alone. What a whole pre-token in the vocabulary becomes depends on its merges and is left
    to the tokenizer itself.
    """
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    if (model.get("type") != "BPE" or normalizer or any((pre_tokenizer or {}).get(k) != v for k, v in plain.items())
            or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))):
        return None
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that a vocabulary writes as they are
    others = [b for b in range(256) if b not in set(kept)]
    byte = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(others)}
    ids = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    if None in ids or any(x >= y for x, y in zip(ids, ids[1:], strict=False)) or len(model["vocab"]) != len(ids) + 256:
        return None
    return {bytes(byte[c] for c in t): i for t, i in model["vocab"].items()}


def has_long_run(text: str) -> bool:
    """Whether the text may hold a run of 2000 characters without, or of nothing but, white space: any such run covers a
    whole stretch of 1000 that begins at a multiple of 1000."""
    return any(_LONG_RUN.match(text, at) for at in range(0, len(text) - 999, 1000))


class TokenizerEncoder:
    """Ids of whole texts from a tokenizer file, as ``encode(text, add_special_tokens=False)`` gives them.

    A file that merges by rank alone (``merge_ranks``) and makes each entry of its vocabulary of that entry's text is
    merged by rank, text by text. For other files distinct pre-tokens go to the tokenizer, and so do texts that hold
    one of its special tokens or a very long run, whose merging by rank would take the square of its length.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import tiktoken
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        about = json.loads(self._tokenizer.to_str())
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        line = self._tokenizer.encode("\n", add_special_tokens=False).ids
        self._line = line[0] if len(line) == 1 else None
        self._ranks = merge_ranks(about["model"], about.get("pre_tokenizer"), about.get("normalizer"))
        if self._ranks and not self._makes_all(self._ranks):
            self._ranks = None
        self._by_rank = self._ranks and tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={})
        self._encoder = PreTokenEncoder(pattern, self._encode_new)
        self.forget = self._encoder.forget

    def _makes_all(self, ranks: dict[bytes, int]) -> bool:
        """Whether each entry that is a text becomes its own id, as merging by rank takes for granted."""
        texts = {}
        for raw, i in ranks.items():
            try:
                texts[raw.decode()] = i
            except UnicodeDecodeError:  # part of a character: never a whole pre-token
                continue
        found = self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return all(f.ids == [i] for f, i in zip(found, texts.values(), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not any(s in t for s in self._special) for t in texts]
        if self._by_rank:
            merge = self._by_rank.encode_ordinary
            return [array("I", merge(t)).tobytes() if p and not has_long_run(t) else self._one(t)
                    for t, p in zip(texts, plain, strict=True)]
        known = iter(self._encoder.encode([t for t, p in zip(texts, plain, strict=True) if p]))
        return [next(known) if p else self._one(t) for t, p in zip(texts, plain, strict=True)]

    def _one(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _encode_new(self, tokens: list[str]) -> list[bytes]:
        return self._many(tokens, self._by_tokenizer)

    def _by_tokenizer(self, parts: list[str]) -> Iterator[list[int]]:
        return (found.ids for found in self._tokenizer.encode_batch_fast(parts, add_special_tokens=False))

    def _many(self, tokens: list[str], encode: Callable[[list[str]], Iterable[list[int]]]) -> list[bytes]:
        """Many pre-tokens in one call, a line break between them: it is a pre-token and an id of its own."""
        out: list[bytes | None] = [None] * len(tokens)
        if self._line is not None:
            words = [i for i, t in enumerate(tokens) if not t[-1:].isspace() and "\n" not in t]
            parts = [words[at:at + 2000] for at in range(0, len(words), 2000)]
            joined = ["\n".join([tokens[i] for i in part]) for part in parts]
            for part, found in zip(parts, encode(joined), strict=True):
                ids = np.array(found, "<u4")
                ends = np.flatnonzero(ids == self._line)
                if len(ends) == len(part) - 1:
                    raw, begin = ids.tobytes(), 0
                    for i, end in zip(part, [*ends.tolist(), len(ids)], strict=True):
                        out[i], begin = raw[4 * begin:4 * end], end + 1
        return [self._one(t) if o is None else o for t, o in zip(tokens, out, strict=True)]


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> TokenizerEncoder:
    return TokenizerEncoder(path, pattern)


class Packer:
    """Packs documents as they come; ``rows`` takes the finished pieces."""

    def __init__(self, shard: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tuple(sorted(tiers)), step_tokens
        self.rows: list[tuple] = []
        self._pools: list[list[tuple]] = [[] for _ in self.tiers]  # of (length, order, doc, start, ids, doc's tokens)
        self._held = [0] * len(self.tiers)
        self._order = 0
        self._next = shard << 32
        self._loads = [0.0] * OPEN_GROUPS
        self._groups = shard << 32

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, top = len(ids) // 4, self.tiers[-1]
        at = 0
        while total - at >= top:
            self._window([(top, 0, doc_id, at, ids[4 * at:4 * (at + top)], total)], top)
            at += top
        if at < total:
            self._route(doc_id, at, ids[4 * at:], total)
        for t, size in enumerate(self.tiers):
            if self._held[t] >= POOL_WINDOWS * size:
                self._pack(t, POOL_WINDOWS * size // 2)

    def close(self) -> None:
        """Pack what is left, longest tier first, then the tail into windows of falling powers of two."""
        for t in reversed(range(len(self.tiers))):
            self._pack(t, 0)
        rest = sum(self._held)
        while rest:
            size = 1 << min(rest.bit_length() - 1, self.tiers[-1].bit_length() - 1)
            self._window(self._fill(len(self.tiers) - 1, size), size)
            rest -= size

    def _route(self, doc_id: int | None, start: int, ids: bytes, total: int) -> None:
        n = len(ids) // 4
        t = bisect_left(self.tiers, n)
        insort(self._pools[t], (n, self._order, doc_id, start, ids, total), key=lambda p: p[:2])
        self._order += 1
        self._held[t] += n

    def _take(self, t: int, i: int) -> tuple:
        piece = self._pools[t].pop(i)
        self._held[t] -= piece[0]
        return piece

    def _pack(self, t: int, keep: int) -> None:
        """Windows of tier ``t`` until its pool is down to ``keep`` tokens or can't fill one with its shorter tiers."""
        size = self.tiers[t]
        while self._pools[t] and self._held[t] > keep and sum(self._held[:t + 1]) >= size:
            self._window(self._fill(t, size), size)

    def _fill(self, t: int, size: int) -> list[tuple]:
        """Pieces of tier ``t`` and shorter that fill ``size`` tokens exactly; at most the last one is cut."""
        taken, gap = [], size
        while gap:
            for k in range(t, -1, -1):  # the longest piece that fits, from the longest tier that has one
                i = bisect_right(self._pools[k], gap, key=lambda p: p[0])
                if i:
                    taken.append(self._take(k, i - 1))
                    gap -= taken[-1][0]
                    break
            else:  # every piece is longer than the gap: cut the shortest
                k = next(k for k in range(t + 1) if self._pools[k])
                n, order, doc_id, start, ids, total = self._take(k, 0)
                taken.append((gap, order, doc_id, start, ids[:4 * gap], total))
                self._route(doc_id, start + gap, ids[4 * gap:], total)
                gap = 0
        return taken

    def _window(self, pieces: list[tuple], size: int) -> None:
        group = min(range(OPEN_GROUPS), key=self._loads.__getitem__)
        if self._loads[group] >= self.step_tokens:
            self._loads, group = [0.0] * OPEN_GROUPS, 0
            self._groups += OPEN_GROUPS
        self._loads[group] += size + size * size / self.tiers[-1]
        offset = 0
        for n, _, doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self._next, offset, size, self._groups + group))
            offset += n
        self._next += 1


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         tiers: tuple[int, ...] = TIERS, eos: int = EOS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row a piece: where its ids stand in the document and in which window, the window's length and step group.

    Tiers are powers of two. Null or empty text is a document of the end id alone; null ids and repeated rows are
    documents of their own; an empty table gives no rows.
    """
    end = np.array([eos], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder, packer = _encoder(tokenizer_path, pattern), Packer(context.partitionId() if context else 0, tiers, step_tokens)

        def done() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = zip(*rows, strict=True) if rows else [()] * len(NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=NAMES)

        for piece in text_pieces(batches):
            for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1).to_pylist()), strict=True):
                packer.add(doc_id, ids + end)
            yield done()
        encoder.forget()
        packer.close()
        yield done()

    return id_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                public_tokenizers.PATTERN)
