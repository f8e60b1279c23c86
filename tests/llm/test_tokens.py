"""Byte-level BPE and packing, against the tokenizers themselves."""

import base64
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SMALL
from helpers import rows
from monthplan.llm import byte_bpe, packing
from monthplan.llm.tables import read_table

TRICKY = ["", " ", "  two  spaces ", "a \n b\n  c\t d", "don't we'll I'M", "naïve café 東京 \U0001f600", "x" * 5000, "<|endoftext|>", "\x00\x01 \u200b\ufeff",
          "1234567890 ²Ⅷ", " .,;: !? a. b, c;", "\n\n\n", "tab\there", "a\u00a0b \u00a0 c", " lead", "trail ", "end.\n"]


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hf():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_bpe_is_that_of_the_library_and_round_trips(tik):
    codec = byte_bpe.ByteBpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for text, ids in zip(TRICKY, codec.encode(TRICKY), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_bpe_rows(spark, tik):
    docs = read_table(spark, SMALL, "documents")
    some = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(None, None), (7, "")], "doc_id long, text string"))
    got = byte_bpe.encode_decode(some, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts) + 2
    for r in got:
        if r.ids:
            assert np.frombuffer(r.ids, "<u4").tolist() == tik.encode_ordinary(texts[r.doc_id])
            assert bytes(r.decoded) == texts[r.doc_id].encode() and r.n_tokens == len(r.ids) // 4
    assert byte_bpe.encode_decode(some.limit(0), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def check_packed(pieces, ids):
    """Every id in one piece, no gaps in a window, whole windows."""
    windows = {}
    for r in pieces:
        of = ids[r.doc_id]
        assert zlib.crc32(of[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(of)
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_length))
    for found in windows.values():
        at = 0
        for offset, length, _ in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at == found[0][2] <= 2048 and at & (at - 1) == 0
    return windows


def test_packing_keeps_every_id_once(spark, hf):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(TRICKY)] + [(20_000, None)], "doc_id long, text string"))
    pieces = packing.pack(docs.repartition(3), P.path("byte_bpe_50k.json"), P.PATTERN).collect()
    ids = {r.doc_id: np.array(hf.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4") for r in docs.collect()}
    check_packed(pieces, ids)
    covered = {}
    for r in pieces:
        covered.setdefault(r.doc_id, []).append((r.start, r.length))
    for doc, of in ids.items():
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == len(of)


def test_packing_edges(spark):
    args = (P.path("byte_bpe_50k.json"), P.PATTERN)
    docs = spark.createDataFrame([(None, None, 1), (1, "a", 2), (1, "a", 2)], "doc_id long, text string, length int")
    assert rows(packing.pack(docs.coalesce(1), *args), "doc_id", "doc_tokens") == [(1, 2), (1, 2), (None, 1)]
    assert packing.pack(docs.limit(0), *args).count() == 0


def test_step_groups_are_balanced():
    packer = packing.Packer(0)
    rng = np.random.default_rng(1)
    for doc in range(3000):
        packer.add(doc, np.zeros(int(rng.integers(1, 3000)), "<u4").tobytes())
    packer.close()
    load = {}
    for sequence, (size, group) in {r[5]: (r[7], r[8]) for r in packer.rows}.items():
        load[group] = load.get(group, 0) + size + size * size / 2048
    full = [v for g, v in load.items() if g // packing.OPEN_GROUPS < max(load) // packing.OPEN_GROUPS]
    assert max(full) - min(full) <= 2 * 2048


def test_merging_by_rank_gives_the_tokenizers_ids():
    """Pieces of the vocabulary in every mixture, other scripts, numbers and marks: what both ways make of them."""
    import random

    rnd = random.Random(2)
    encoder = packing.TokenizerEncoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    assert encoder._ranks is not None and len(encoder._ranks) == 50_256
    vocabulary = [t.decode() for t in encoder._ranks if t.isascii() and t.strip().isalpha()]
    words = {"".join(rnd.choice(vocabulary).strip() for _ in range(rnd.randint(1, 4))) for _ in range(20_000)}
    words |= {"".join(rnd.choice("etaoinsr") for _ in range(rnd.randint(1, 12))) for _ in range(20_000)}
    words |= {"".join(chr(rnd.choice([rnd.randint(0xC0, 0x24F), rnd.randint(0x4E00, 0x9FFF)])) for _ in range(rnd.randint(1, 6))) for _ in range(4000)}
    words |= {" " + w for w in list(words)[::3]} | {"1234567", " 0", "!?!", " --", "'s", "a" * 5000} | set(vocabulary[::7])
    words = sorted(words)
    assert encoder._encode_new(words) == encoder._many(words, encoder._by_tokenizer)


def test_a_tokenizer_of_another_kind_is_asked_itself():
    encoder = packing.TokenizerEncoder(P.path("word_bpe_49k.json"), P.PATTERN)
    assert encoder._ranks is None
    broken = {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b"]}
    assert packing.merge_ranks(broken, {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, None) is None


def test_whole_texts_get_the_tokenizers_ids():
    """Words, marks and white space in every mixture, special tokens and long runs: ids of the whole text at once."""
    import random

    rnd = random.Random(3)
    encoder = packing.TokenizerEncoder(P.path("byte_bpe_50k.json"), P.PATTERN)
    vocabulary = [t.decode() for t in encoder._ranks if t.isascii()]
    odd = ["  ", "\n\n", "\t", "\u00a0", "\u2003x", "'ll", "\u0661\u0662", "\u4e2d\u6587", "\U0001f600", "e\u0301", "\x00", "\u200b", "\ufeff", "\x85", "\x1c"]
    texts = ["".join(rnd.choice(rnd.choice((vocabulary, odd))) for _ in range(rnd.randint(0, 60))) for _ in range(5000)]
    texts += vocabulary + odd + ["", "a" * 300_000, " " * 300_000 + "b", "x " * 500 + "ab" * 3000, "ab" * 999, *encoder._special]
    texts += [f"one {s} two" for s in encoder._special]
    assert encoder.encode(texts) == [np.array(encoder._tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
