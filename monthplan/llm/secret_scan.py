"""Secret scan with structural confirmation.

Base findings come from three fixed patterns. The method adds spans of its own: candidates that look like base64 or
hex are decoded, and only those whose bytes parse are reported:

* ``jwt``      three base64url parts whose first decodes to a JSON header with an ``alg``, and whose second is JSON,
* ``key``      DER (a SEQUENCE whose nested lengths fill it exactly and that opens as a private key does: an INTEGER
               version followed by key material, or a password-based algorithm and what it encrypts) or an OpenSSH
               private key (magic, then length-prefixed strings), in base64 or hex, also split into the lines of a PEM
               body, whose line breaks may be escaped as in JSON and source strings; a PEM body under a DEK-Info header
               is ciphertext, confirmed by whole blocks of the header's initial vector,
* ``encoded``  base64 or hex of printable ASCII that itself holds an assignment or access key.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .tables import carried_schema, id_text, read_table, text_pieces

#: The base patterns, their kinds in order, and the least length (of group 2 for assign).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # a run of hex digits is one match; shorter runs fail
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "jwt", "key", "encoded")
BASE_KINDS = KINDS[:3]

_WORDS = ("passw", "secret", "token", "api")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----((?:(?!-----).)++)-----END [A-Z0-9 ]*PRIVATE KEY-----", re.S)
_BREAK = re.compile(r"""\\+(?:[nrt]|\s|(?=/))|["']\s*[+.,]?\s*["']""")  # escaped white space or slash, strings put together
_DEK = re.compile(r"DEK-Info:\s*[A-Za-z0-9-]+,\s*([0-9A-Fa-f]{16}|[0-9A-Fa-f]{32})")
_PBE = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))  # PKCS 5 and PKCS 12 encryption by a password
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
_ALL_HEX = re.compile(r"(?:[0-9a-f]{2})+|(?:[0-9A-F]{2})+")
_PRINTABLE = re.compile(rb"[\t\n\r\x20-\x7e]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of the base findings, leftmost and non-overlapping within a kind."""
    found = []
    low = text.lower()  # only asked for presence: what the pattern's letters match is ASCII
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def decode64(text: str) -> bytes | None:
    """Standard or URL-safe base64, padded or not; None if it is neither."""
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der(data: bytes, at: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the element at ``at``, or None if its length doesn't fit."""
    if at + 2 > len(data):
        return None
    tag, n, start = data[at], data[at + 1], at + 2
    if n & 0x80:
        width = n & 0x7F
        if not 1 <= width <= 4 or start + width > len(data):
            return None
        n, start = int.from_bytes(data[start:start + width], "big"), start + width
    return (tag, start, start + n) if start + n <= len(data) else None


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE over the whole data whose children fill it: an INTEGER of 0 or 1, then key material; or an algorithm
    of encryption by a password, then an OCTET STRING."""
    outer = _der(data, 0)
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    children, at = [], outer[1]
    while at < outer[2]:
        child = _der(data, at)
        if child is None or child[2] > outer[2] or len(children) >= 16:
            return False
        children.append(child)
        at = child[2]
    if [c[0] for c in children] == [0x30, 0x04]:  # the same shape under other algorithms is a digest
        name = _der(data[:children[0][2]], children[0][1])
        return name is not None and name[0] == 0x06 and data[name[1]:name[2]].startswith(_PBE) and children[1][2] > children[1][1]
    if len(children) < 2 or children[0][0] != 0x02 or data[children[0][1]:children[0][2]] not in (b"\0", b"\1"):
        return False
    tags = [c[0] for c in children[1:]]
    pkcs1 = len(tags) >= 5 and all(t == 0x02 for t in tags[:5])
    pkcs8 = tags[0] == 0x30 and len(tags) > 1 and tags[1] == 0x04
    sec1 = tags[0] == 0x04 and children[1][2] - children[1][1] >= 16
    return pkcs1 or pkcs8 or sec1


def is_openssh_key(data: bytes) -> bool:
    """The OpenSSH magic, then cipher, kdf and options as length-prefixed strings and a count of keys."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        if at > len(data):
            return False
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 64


def is_jwt(text: str) -> bool:
    header, payload = text.split(".")[:2]
    try:
        head, body = json.loads(decode64(header) or b""), json.loads(decode64(payload) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def confirm(text: str) -> str | None:
    """The kind of a base64 or hex candidate, or None if nothing in it parses."""
    decoded = [d for d in (bytes.fromhex(text) if _ALL_HEX.fullmatch(text) else None, decode64(text)) if d]
    for data in decoded:
        if is_der_key(data) or is_openssh_key(data):
            return "key"
        if _PRINTABLE.fullmatch(data) and any(k < 2 for _, k, _ in base_spans(data.decode("ascii"))):
            return "encoded"
    return None


def is_pem_key(body: str) -> bool:
    """What stands between the armour lines: header lines, if any, then base64 of a key."""
    lines = [line.strip() for line in _BREAK.sub("\n", body).splitlines()]
    first = next((i for i, line in enumerate(lines) if line and ":" not in line), len(lines))
    data = decode64("".join("".join(lines[first:]).split()))
    if not data:
        return False
    vector = _DEK.search("\n".join(lines[:first]))
    if vector:
        return len(data) % (len(vector[1]) // 2) == 0
    return is_der_key(data) or is_openssh_key(data)


def method_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's index, end) of candidates that decode to a structure; a PEM body counts from BEGIN to END."""
    found = []
    if "." in text:
        found += [(m.start(), 3, m.end()) for m in _JWT.finditer(text) if is_jwt(m[0])]
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if is_pem_key(m[1]):
                found.append((m.start(), 4, m.end()))
    within = [(s, e) for s, _, e in found]
    for m in _RUN.finditer(text):
        if any(s <= m.start() < e for s, e in within):
            continue
        kind = confirm(m[0])
        if kind:
            found.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each maximal run of spans replaced by a marker."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long,"
          " masked string")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", masked: bool = True,
                 carry: Sequence[str] = ()) -> DataFrame:
    """One row a document: counts of base findings, their digest, all spans, confirmed count, the masked text, and the
    columns to carry along.

    Null text counts as empty (no findings, the digest of the empty string); null ids, repeated rows and very long
    texts are handled row by row; offsets are code points, ends exclusive. ``masked`` is null if not asked for.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_pieces(batches):
            rows = []
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                base, more = base_spans(text), method_spans(text)
                every = sorted(base + more)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every),
                             len(more), mask(text, every) if masked else None))
            found = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([*found, *piece.columns[2:]], names=[*NAMES, *carry])

    return id_text(docs, id_col, text_col, carry).mapInArrow(scan, SCHEMA + carried_schema(docs, carry))


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
TYPES = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.string()]


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"), masked=False).drop("masked")
