import base64
import hashlib
import json
import re
import struct

import pytest

from helpers import rows
from monthplan.llm import secret_scan as sc


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


KEY = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([k + 1]) * 40) for k in range(8)))
SSH = b"openssh-key-v1\0" + b"".join(struct.pack(">I", len(s)) + s for s in (b"none", b"none", b"")) + struct.pack(">I", 1) + b"x" * 40


def b64(data):
    return base64.b64encode(data).decode()


def jwt(header):
    return ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in (header, {"sub": "1"})) + ".c2ln"


def kinds(text):
    return [sc.KINDS[k] for _, k, _ in sc.method_spans(text)]


def test_structures_are_confirmed_and_lookalikes_are_not():
    assert kinds("a " + b64(KEY) + " b") == ["key"]
    assert kinds("a " + KEY.hex() + " b") == ["key"]
    assert kinds(b64(SSH)) == ["key"]
    body = b64(KEY)
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(body[i:i + 64] for i in range(0, len(body), 64)) + "\n-----END RSA PRIVATE KEY-----"
    assert kinds(f"x {pem} y") == ["key"] and sc.method_spans(f"x {pem} y")[0][::2] == (2, 2 + len(pem))
    assert kinds(jwt({"alg": "HS256"})) == ["jwt"] and kinds(jwt({"typ": "JWT"})) == []
    assert kinds(b64(b"password = abcdefghijklmnop")) == ["encoded"]
    assert kinds(b64(KEY[:-3])) == [] and kinds("A" * 80) == [] and kinds("0" * 64) == [] and kinds(b64(bytes(range(90)))) == []


def test_keys_under_headers_escaped_or_encrypted_are_confirmed():
    def armour(kind, data, head=(), end="\n"):
        body = b64(data)
        return end.join([f"-----BEGIN {kind}PRIVATE KEY-----", *head, *(body[i:i + 64] for i in range(0, len(body), 64)), f"-----END {kind}PRIVATE KEY-----"])

    pbes2 = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")) + der(0x30, der(4, b"salt")))
    digest = der(0x30, der(6, bytes.fromhex("608648016503040201")) + der(5, b""))
    locked = der(0x30, pbes2 + der(4, bytes(range(200, 248)) * 20))
    dek = ("Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF", "")
    for pem in (armour("RSA ", KEY, end="\\n"), armour("RSA ", KEY, end="\\\\n"), armour("", KEY, end="\\r\\n"), armour("OPENSSH ", SSH, end="\\n"),
                armour("RSA ", KEY, end='\\n" +\n  "'), armour("RSA ", KEY, end="\\n").replace("/", "\\/"), armour("ENCRYPTED ", locked),
                armour("RSA ", bytes(range(256)) * 3, dek), armour("RSA ", bytes(range(256)) * 3, dek, "\\n"), armour("RSA ", KEY, ("Comment: x",))):
        text = '\u00e9 {"private_key": "' + pem + '\\n"}'
        assert [s[::2] for s in sc.method_spans(text) if s[1] == 4] == [(19, 19 + len(pem))], pem
        assert sc.mask(text, sc.method_spans(text)) == '\u00e9 {"private_key": "[SECRET]\\n"}'
    assert kinds("a " + b64(locked) + " b") == ["key"]
    assert kinds(b64(der(0x30, digest + der(4, bytes(range(32)))))) == []  # a digest has the same shape
    assert kinds(armour("RSA ", bytes(range(256)) * 3)) == [] and kinds(armour("RSA ", bytes(range(255)) * 3, dek)) == []
    assert kinds("-----BEGIN PRIVATE KEY-----\n" * 3 + "words: and more\n" + armour("", KEY)) == ["key"]


def test_base_spans_are_leftmost_and_whole():
    text = "PassWord='abcdefghijkl' token:secret:longvalue123456 AKIAABCDEFGHIJKLMN0 AKIASHORT 0123456789abcdef 0123 api_key=short"
    found = [(sc.KINDS[k], text[s:e]) for s, k, e in sc.base_spans(text)]
    assert found == [("assign", "PassWord='abcdefghijkl"), ("access", "AKIAABCDEFGHIJKLMN0"), ("hex", "0123456789abcdef")]
    assert sc.base_spans("pa\u017fsword=abcdefghijkl") == []  # a long s is no letter of the pattern
    assert sc.mask(text, sc.base_spans(text)).count("[SECRET]") == 3


def test_rows_and_edges(spark):
    texts = [(1, None), (2, ""), (3, "\u00e9\u00e9 token=abcdefghijklmnop"), (3, "\u00e9\u00e9 token=abcdefghijklmnop"), (None, "AKIA" + "A" * 16),
             (5, "x" * 300_000 + " secret: " + "y" * 20)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in texts], "doc_id long, text string, spans string")
    got = rows(sc.scan_secrets(docs), "doc_id", "n_assign", "n_access", "n_hex", "spans", "base_sha256")

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    span = "assign:3:25"
    far = "assign:300001:300029"
    assert got == [(1, 0, 0, 0, "", sha("")), (2, 0, 0, 0, "", sha("")), (3, 1, 0, 0, span, sha(span)), (3, 1, 0, 0, span, sha(span)),
                   (5, 1, 0, 0, far, sha(far)), (None, 0, 1, 0, "access:0:20", sha("access:0:20"))]
    assert sc.scan_secrets(docs.limit(0)).count() == 0


PLAIN = (("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
         ("access", r"AKIA[A-Z0-9]+", 18), ("hex", r"[0-9a-f]+", 16))


def plain_base(text):
    """Counts by kind, the digest and the spans as the rules state them: every match in turn, failing ones dropped."""
    found = []
    for order, (kind, pattern, least) in enumerate(PLAIN):
        for m in re.finditer(pattern, text, re.A):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), order, m.end()))
    spans = [f"{PLAIN[k][0]}:{s}:{e}" for s, k, e in sorted(found)]
    counts = [sum(k == i for _, k, _ in found) for i in range(3)]
    return *counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), spans


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_plain_matching_over_all_documents(spark, sf_dir):
    got = sc.op6_secret_scan(spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    seen = [0, 0, 0]
    for r in got:
        *counts, digest, spans = plain_base(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]] == [*counts, digest], r["doc_id"]
        every = r["spans"].split(",") if r["spans"] else []
        assert [s for s in every if s.split(":")[0] in sc.BASE_KINDS] == spans, r["doc_id"]
        assert len(every) - len(spans) == r["n_confirmed"]
        seen = [a + b for a, b in zip(seen, counts, strict=True)]
    assert sum(seen) > 0, seen


def test_base_spans_match_plain_matching_on_random_mixtures():
    import random

    rng = random.Random(5)
    bits = ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "'", '"', " ", "  ", "=", ":", "\n", "AKIA", "AKI", "A1B2C3D4E5F6G7", "0123456789abcdef",
            "deadbeef", "f", "-", "_", ".", "+/", "abcdefghijkl", "\u017f", "\u212a", "\u00e9", "x"]
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        base = sc.base_spans(text)
        assert [f"{sc.KINDS[k]}:{s}:{e}" for s, k, e in base] == plain_base(text)[4], text
