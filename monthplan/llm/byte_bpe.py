"""Byte-level BPE through a sentencepiece model written straight from the ranks, and its inverse.

The 256 bytes are mapped to printable code points, so every rank of the vocabulary becomes a piece of such characters.
The pieces are serialised as a sentencepiece BPE model: piece ``r`` has the score ``-r`` (the best-scored merge is the
one of lowest rank), normalisation is the identity, no dummy prefix, no white-space escapes, and one unknown piece
follows the ranks. Each match of the pre-token pattern is encoded by it; decoding maps ids back to their bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .pretokens import PreTokenEncoder
from .tables import id_text, read_table, text_pieces


def byte_alphabet() -> list[str]:
    """A distinct printable character for each byte: itself where Latin-1 prints it, else one from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The byte string of every rank, from lines of base64 and rank; ranks have no gaps."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must count up from 0 without gaps")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protocol-buffer field: varint for int, 32-bit for float, length-delimited for bytes."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(ranks: list[bytes]) -> bytes:
    """A serialised sentencepiece ModelProto whose BPE merges are those of the ranks, with id = rank."""
    alphabet = byte_alphabet()
    pieces = []
    for rank, token in enumerate(ranks):
        text = "".join(alphabet[b] for b in token).encode()
        pieces.append(_field(1, _field(1, text) + _field(2, float(-rank)) + _field(3, 1)))  # NORMAL
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))  # UNKNOWN
    trainer = b"".join([_field(3, 2), _field(4, len(ranks) + 1), _field(24, 0),  # BPE, its size, no white-space split
                        _field(40, len(ranks)), _field(41, (1 << 64) - 1), _field(42, (1 << 64) - 1),
                        _field(43, (1 << 64) - 1)])  # the unknown id; no bos, eos or pad
    normalizer = b"".join([_field(1, b"identity"), _field(3, 0), _field(4, 0), _field(5, 0)])
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBpe:
    """Encoder and decoder of one vocabulary; ``path`` must be readable on every executor."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.ranks = read_ranks(path)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self._whole = {token: rank for rank, token in enumerate(self.ranks)}
        self._map = {b: c for b, c in enumerate(byte_alphabet())}
        self._encoder = PreTokenEncoder(pattern, self._encode_new)
        self.encode, self.forget = self._encoder.encode, self._encoder.forget

    def _encode_new(self, tokens: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(tokens)
        open_at, mapped = [], []
        for i, token in enumerate(tokens):
            raw = token.encode("utf-8", "surrogatepass")
            rank = self._whole.get(raw)  # a pre-token that is in the vocabulary is one id, whatever merges lead to
            if rank is None:
                open_at.append(i)
                mapped.append(raw.decode("latin-1").translate(self._map))
            else:
                out[i] = struct.pack("<I", rank)
        for i, ids in zip(open_at, self._model.encode(mapped, num_threads=1), strict=True):
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=4)
def _codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``keep_ids``, ids (binary) and decoded (binary).

    One row for each row; null text counts as empty (no ids); null ids and repeated rows pass through.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    if keep_ids:
        schema, types = schema + ", ids binary, decoded binary", types + [pa.binary(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path, pattern)
        for piece in text_pieces(batches):
            columns: list[list] = [piece.column(0).to_pylist(), [], [], [], [], []]
            for ids in codec.encode(piece.column(1).to_pylist()):
                decoded = codec.decode(ids)
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(), ids, decoded)
                for column, value in zip(columns[1:len(types)], row, strict=False):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)
        codec.forget()

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN, keep_ids=False)
