import hashlib
import random

import pytest
from conftest import SMALL
from helpers import repeats, rows
from monthplan.llm import radix_dedup as rd
from monthplan.llm.tables import read_table


def compare(spark, texts, size, gram):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.kept_sha256)
           for r in rd.remove_repeats(frame, size=size, gram=gram).collect()}
    want = {d: (*v, hashlib.sha256(v[3]).hexdigest()) for d, v in repeats(texts, size).items()}
    assert got == want


@pytest.mark.parametrize("size,gram", [(12, 5), (12, 11), (30, 8)])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "aé"])
def test_random_texts_against_every_window(spark, size, gram, alphabet):
    rnd = random.Random(size * gram)
    parts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(2, 50))) for _ in range(30)]
    texts = {i: "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 6))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "a" * 400, 63: "a" * 400, 64: texts[3], 65: "b" * 11, 66: "b" * 12}
    compare(spark, texts, size, gram)


def test_given_documents_against_every_window(spark):
    docs = read_table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rd.op9_radix_dedup(spark, SMALL).collect()}
    assert got == {d: (*v[:3], hashlib.sha256(v[3]).hexdigest()) for d, v in repeats(texts, 100).items()}


def test_edges(spark):
    text = "".join(chr(97 + i * 7 % 26) for i in range(150))
    frame = spark.createDataFrame([(2, text, 1), (2, text, 1), (1, "short", 1), (None, text, 1)], "doc_id long, text string, kept int")
    got = rows(rd.remove_repeats(frame), "doc_id", "n_bytes", "n_removed", "n_spans")
    inner = repeats({0: text}, 100)[0][1:3]
    assert got == [(1, 5, 0, 0), (2, 150, 150, 1), (2, 150, 150, 1), (None, 150, *inner)]
    twice = rd.remove_repeats(frame.where("doc_id = 2"))  # a repeated row is the same document
    assert rows(twice, "n_removed") == [(inner[0],), (inner[0],)]
    assert rd.remove_repeats(frame.limit(0)).count() == 0


def test_rows_of_one_id_or_none_keep_what_is_found_apart(spark):
    """A passage that repeats in one row of an id takes nothing out of another row of it."""
    rnd = random.Random(9)
    other = "".join(rnd.choice("abcdefghij") for _ in range(500))
    twice = "".join(rnd.choice("klmnopqrst") for _ in range(150))
    frame = spark.createDataFrame([(7, twice + " " + twice), (7, other), (None, other[:300] + twice), (None, "x" + "y".join(map(str, range(400))))],
                                  "doc_id long, text string")
    got = {bytes(r.kept).decode(): (r.doc_id, r.n_removed) for r in rd.remove_repeats(frame).collect()}
    texts = [t for _, t in frame.collect()]
    assert got[texts[3]] == (None, 0) and got[texts[2]] == (None, 0)  # nothing stands before the null ids
    assert sorted((i, n) for i, n in got.values() if i == 7) == [(7, 300), (7, 300)]


@pytest.mark.parametrize("chunk", [64, 500])
def test_long_texts_in_pieces_against_every_window(spark, chunk):
    rnd = random.Random(chunk)
    parts = ["".join(rnd.choice("abcdef") for _ in range(rnd.randrange(10, 90))) for _ in range(40)]
    texts = {1: "".join(rnd.choice(parts) for _ in range(150)), 2: parts[0] * 9, 3: "".join(parts), 4: "ab" * 700, 5: None, 6: "".join(parts)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in rd.remove_repeats(frame, size=30, gram=8, chunk_bytes=chunk).collect()}
    assert got == repeats(texts, 30)


def test_a_very_long_text(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    raw = bytearray(rng.integers(97, 123, 12_000_000, dtype=np.uint8).tobytes())
    raw[9_000_050:9_000_250] = raw[1_000_000:1_000_200]  # across the edge of a piece
    raw[4_999_900:5_000_300] = raw[20:420]
    frame = spark.createDataFrame([(1, raw.decode()), (2, raw[6_000_000:6_000_150].decode())], "doc_id long, text string")
    assert rows(rd.remove_repeats(frame, with_text=False), "doc_id", "n_removed", "n_spans") == [(1, 600, 2), (2, 150, 1)]
