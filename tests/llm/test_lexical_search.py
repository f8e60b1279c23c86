"""Ranked search against scoring every document for every item."""

import math
import random
import re

import numpy as np
import pytest
from conftest import MEDIUM
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from monthplan.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, items, k=20):
    held = [(i, split(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, length = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item_id, item in items:
        scored = []
        for doc_id, w in held:
            m = 100 - 25 + (25 * len(w) * n_docs) // length
            score = 0
            for t in split(item):
                tf = w.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0 and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item_id, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    return rows(ls.search(d, b, **options), "item_id", "rank", "doc_id", "score")


def corpus(seed, n_docs=300):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(150)] + ["Été", "ÉTÉ", "Über"]
    pick = lambda n: " ".join(rng.choices(vocab, [1 / (1 + i) for i in range(len(vocab))], k=n))
    docs = [(i, pick(rng.randint(0, 60))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[7][1]) for i in range(60)]  # copies: ties beyond the twenty
    items = [(i, pick(rng.choice([1, 5, 30]))) for i in range(12)] + [(50, docs[7][1])]
    rng.shuffle(docs)
    return docs, items


def test_against_every_document(spark):
    docs, items = corpus(1)
    assert found(spark, docs, items) == plain(docs, items)


def test_small_trees_parts_and_query_blocks_give_the_same(spark):
    docs, items = corpus(2)
    assert found(spark, docs, items, leaf=3, chunk_rows=40, part_rows=100, query_bytes=300, k=7) == plain(docs, items, 7)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..!"), (4, "Cat dog"), (4, "cat DOG"), (None, "cat"), (5, "cat " * 3000), (6, "Ärger"), (7, "ärger 1a")]
    items = [(1, "CAT"), (2, None), (3, "zzz"), (None, "dog dog"), (1, "Ärger"), (4, "1A"), (5, "!")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, []) == [] and found(spark, [], items) == []


def test_long_text_is_cut_at_spaces():
    text = "abc é1 " * 400_000 + "end"
    assert ls.terms(text) == {b"abc": 400_000, "é1".encode(): 400_000, b"end": 1}
    assert ls.terms("x" * 3_000_000 + " y") == {b"x" * 3_000_000: 1, b"y": 1}


def vectors(rng, n, wide, scale):
    ptr = np.concatenate([[0], np.cumsum(rng.integers(1, 9, n))])
    idx = np.concatenate([np.sort(rng.choice(wide, b - a, replace=False)) for a, b in zip(ptr[:-1], ptr[1:], strict=True)])
    return ptr, idx, rng.integers(1, scale, ptr[-1])


@settings(max_examples=40, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(1, 150), scale=st.sampled_from([2, 50, 1_000_000]), leaf=st.sampled_from([1, 4, 64]))
def test_no_ball_holds_a_score_beyond_its_bound(seed, n, scale, leaf):
    rng = np.random.default_rng(seed)
    ptr, idx, val = vectors(rng, n, 20, scale)
    tree = ls.BallTree(np.arange(n), ptr, idx, val, np.ones(20), leaf)
    queries = [(np.sort(rng.choice(20, c, replace=False)), rng.integers(0, 20_000, c)) for c in rng.integers(0, 12, 6)]
    bound = tree.bounds(queries)
    for j, (t, v) in enumerate(queries):
        dense = np.zeros(20, np.int64)
        dense[t] = v
        score = np.array([int((tree.val[a:b] * dense[tree.idx[a:b]]).sum()) for a, b in zip(tree.ptr[:-1], tree.ptr[1:], strict=True)])
        for node, (a, b) in enumerate(tree.span):
            assert score[a:b].max() <= bound[node, j]


def test_most_leaves_are_left_out(spark):
    """On the given tables the bounds have to spare work, not only to be right."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    items = [r.text for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    held = [ls.terms(t) for t in items]
    place = {w: i for i, w in enumerate(sorted(set().union(*held)))}
    kept = [(r.doc_id, {place[w]: c for w, c in ls.terms(r.text).items() if w in place}) for r in docs]
    kept = [(i, c) for i, c in kept if c]
    ptr = np.concatenate([[0], np.cumsum([len(c) for _, c in kept])])
    idx = np.concatenate([list(c) for _, c in kept]).astype(np.int64)
    f = np.concatenate([list(c.values()) for _, c in kept]).astype(np.int64)
    w = np.array([ls.weight(len(kept), d) for d in np.bincount(idx, minlength=len(place))], np.int64)
    tree = ls.BallTree(np.array([i for i, _ in kept]), ptr, idx, 10**9 * f // (1000 * f + 1200), w.astype(float), 8)
    queries = [(t, w[t]) for t in (np.array(sorted(place[x] for x in one), np.int64) for one in held)]
    tree.search(queries, [[] for _ in queries], 20, len(place))
    leaves = sum(c[0] < 0 for c in tree.child)
    assert tree.scored < 0.6 * leaves * len(queries)


@pytest.mark.parametrize("rows_,entries", [(1, 10), (3, 10**6), (100, 4)])
def test_chunks_keep_every_row(rows_, entries):
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 7)), pa.array([[1] * (i % 6 + 1) for i in range(7)], pa.list_(pa.int32()))],
                                          ["doc_id", "t"]) for a in (0, 7, 14)]
    out = list(ls._chunks(iter(batches), rows_, entries))
    assert [i for t in out for i in t.column(0).to_pylist()] == list(range(21))
    assert all(t.num_rows <= rows_ and (t.num_rows == 1 or sum(len(x) for x in t.column(1).to_pylist()) <= entries) for t in out)
