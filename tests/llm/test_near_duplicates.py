"""MinHash over documents and pivots over vectors, against all pairs."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from helpers import components, rows
from monthplan.llm import circulant_minhash as cm
from monthplan.llm import pivot_dedup as pv
from monthplan.llm.components import connected_components, forest
from monthplan.llm.shingles import shingle_sets


def plain_sets(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)}


def near_copies(seed, n=160):
    rnd = random.Random(seed)
    base = [" ".join(f"w{rnd.randrange(4000)}" for _ in range(150)) for _ in range(4)]
    texts = []
    for _ in range(n):
        words = base[rnd.randrange(4)].split()
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 4, 5, 9])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(9999)}"
        texts.append(" ".join(words))
    return texts


def test_shingles_are_those_of_the_words():
    texts = ["", " \t\n", "one", "A b\x0bC d", "a b c d e", "a b c d e f a b c d e", "É é\u00a0x y z w v", "w " * 50, "\x00 a \x00 b c d"]
    for text, found in zip(texts, shingle_sets(texts), strict=True):
        assert len(found) == len(plain_sets(text)), text
    same = shingle_sets(["A b C d", "a B c D", "a b", "b a", "ab", "a b c d"])
    assert same[0].tolist() == same[1].tolist() == same[5].tolist() and len({s.tobytes() for s in same}) == 4


def test_signatures_estimate_similarity():
    texts = near_copies(2, 60)
    sets = shingle_sets(texts)
    sigs = [cm.signature(s, 512) for s in sets]
    off = []
    for i in range(0, 60, 2):
        a, b = sets[i], sets[i + 1]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        off.append((sigs[i] == sigs[i + 1]).mean() - true)
    assert abs(np.mean(off)) < 0.02 and np.abs(off).max() < 0.12


def expected(texts):
    sets = {i: plain_sets(t) for i, t in texts.items() if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    return sets, components(ids, links)


def test_documents_against_all_pairs_and_edges(spark):
    texts = dict(enumerate(near_copies(5))) | {900: None, 901: "", 902: " \n", 903: "one two", 904: "ONE  two", 905: "two one", 906: "z " * 20_000}
    docs = spark.createDataFrame([(i, t, True) for i, t in texts.items()] + [(903, "one two", True), (None, "one two", True)],
                                 "doc_id long, text string, kept boolean")
    sets, top = expected(texts)
    got = rows(cm.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    want = [(i, len(sets[i]), top[i], top[i] == i) for i in sorted(texts) for _ in range(2 if i == 903 else 1)]
    assert got == [*want, (None, 1, None, True)]


def test_an_id_with_two_texts_joins_their_groups(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b), (4, "x")], "doc_id long, text string")
    got = cm.near_duplicates(docs).select("doc_id", "component_id").distinct()
    assert rows(got, "doc_id", "component_id") == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_leftover_clusters_are_compared_in_blocks(spark):
    texts = dict(enumerate(near_copies(8, 90)))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets, top = expected(texts)
    star = spark.createDataFrame([(i, 0) for i in range(1, 90)], "rep long, hub long")
    nothing = spark.createDataFrame([], "id long, component_id long")
    links = cm.cluster_links(star, nothing, frame, 5, 85, block_rows=16).collect()
    found = components(range(90), [(r.a, r.b) for r in links])
    assert found == top


def test_a_large_component_is_copied_a_few_times(spark):
    """A stray document beside a component of 5,000, and a cluster of many components of all sizes."""
    stray = [(0, 7, i) for i in range(5000)] + [(0, 9000, 9000)]
    mixed = [(1, c, 100_000 + 100 * c + i) for c in range(40) for i in range(1 + c * c // 20)]
    frame = spark.createDataFrame(stray + mixed, "cluster long, component long, doc long")
    got = cm.block_pairs(frame, 16).collect()
    per_doc = Counter(r.doc for r in got if r.pair.cluster == 0)
    assert len(per_doc) == 5001 and max(n for d, n in per_doc.items() if d != 9000) == 1
    assert per_doc[9000] == -(-5000 // 16)
    groups = {}
    for r in got:
        groups.setdefault(r.pair, []).append((r.side, r.component, r.doc))
    met = Counter()
    for rows_ in groups.values():
        two = rows_[0][0] != cm.ALONE
        for (s, c, d), (t, e, f) in itertools.combinations(rows_, 2):
            if c != e and (s != t or not two):
                met[min(d, f), max(d, f)] += 1
    wanted = {(min(d, f), max(d, f)) for x in (stray, mixed) for (_, c, d), (_, e, f) in itertools.combinations(x, 2) if c != e}
    assert set(met) == wanted and set(met.values()) == {1}


def test_empty_documents(spark):
    assert cm.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(60)]
    ids = {i for e in edges for i in e if e[0] != e[1]}
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert dict(map(tuple, got.collect())) == {i: c for i, c in components({i for e in edges for i in e}, edges).items() if i in ids}


def clustered(seed, n, dim=32):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.standard_normal((n, dim)) * rng.choice([0.1, 0.25, 0.4], n)[:, None]
    x[: n // 10] = x[0]
    return x


@pytest.mark.parametrize("block_rows", [2048, 40])
def test_vectors_against_all_pairs(spark, block_rows):
    x = clustered(3, 400)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in pv.near_duplicates(frame, block_rows=block_rows).collect()}
    degrees = np.array([got[i].n_links for i in range(400)])
    assert (degrees <= near.sum(axis=1)).all() and degrees.sum() >= 0.95 * near.sum()
    top = components(range(400), list(zip(*np.nonzero(near), strict=True)))
    assert np.mean([got[i].component_id == top[i] for i in range(400)]) > 0.98
    every = {r.vec_id: r.n_links for r in pv.near_duplicates(frame, block_rows=block_rows, shared=1, pivots=20).collect()}
    assert [every[i] for i in range(400)] == near.sum(axis=1).tolist()  # one shared pivot of all: exact


@pytest.mark.parametrize("block_rows", [2048, 500])
def test_a_crowd_of_similar_vectors_keeps_its_links(spark, block_rows):
    rng = np.random.default_rng(11)
    x = rng.standard_normal((9000, 64))
    x[:3000] = x[0] + x[:3000] * rng.choice([0.18, 0.25, 0.4], 3000)[:, None]  # a third of all
    x[3000:3200] = x[3200:3400] + x[3000:3200] * 0.35  # pairs
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in pv.near_duplicates(frame, block_rows=block_rows).collect()}
    degrees = np.array([got[i].n_links for i in range(9000)])
    assert (degrees <= near.sum(axis=1)).all() and degrees.sum() >= 0.999 * near.sum()
    top = dict(forest(near, np.arange(9000)))
    assert np.mean([got[i].component_id == top.get(i, i) for i in range(9000)]) > 0.999


@pytest.mark.parametrize("mean", [0.5, 0.7])
def test_vectors_with_a_common_direction_keep_their_links(spark, mean):
    rng = np.random.default_rng(12)
    u = rng.standard_normal((5000, 64))
    far = (0.92 - mean) / (1 - mean)  # what a pair at a cosine of 0.92 has in common beside the mean
    u[:1000] = u[1000:2000] + u[:1000] * np.sqrt(1 / far ** 2 - 1)
    u[2000:2400] = u[2400] + u[2000:2400] * rng.choice([0.3, 0.5], 400)[:, None]
    u[:, 0] = 0
    x = np.sqrt(1 - mean) * u / np.linalg.norm(u, axis=1, keepdims=True)
    x[:, 0] = np.sqrt(mean)
    x *= rng.uniform(0.1, 10, 5000)[:, None]
    off, pivots = pv.fitted(x[2500:3500])
    assert off is not None and len(pivots) > 900  # without the mean taken off a common direction leaves a few
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in pv.near_duplicates(frame, pivots=2000).collect()}
    degrees = np.array([got[i].n_links for i in range(5000)])
    assert (degrees <= near.sum(axis=1)).all() and degrees.sum() >= 0.999 * near.sum()
    top = dict(forest(near, np.arange(5000)))
    assert np.mean([got[i].component_id == top.get(i, i) for i in range(5000)]) > 0.999


def test_the_mean_is_taken_off_only_between_its_bounds():
    rng = np.random.default_rng(13)
    spread, line = rng.standard_normal((500, 64)), np.outer(rng.uniform(1, 2, 500), np.ones(64))
    assert pv.fitted(spread)[0] is None and pv.fitted(line)[0] is None and pv.fitted(spread[:1])[0] is None
    mean = np.zeros(64)
    mean[0] = 1.0
    assert not pv.directions(mean[None, :], mean).any()  # nothing beside the mean, no division by zero


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [1e-200, 0.0])]
    frame = spark.createDataFrame([(i, v, 5) for i, v in data], "vec_id long, embedding array<double>, n_links int")
    got = rows(pv.near_duplicates(frame), "vec_id", "n_links", "component_id", "kept")
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)]
    assert got == [(1, 3, 1, True), (2, 3, 1, False), *alone, (9, 3, 1, False), (9, 3, 1, False), (10, 0, 10, True),
                   (11, 0, 11, True), (12, 3, 1, False), (None, 0, None, True)]
    assert pv.near_duplicates(frame.limit(0)).count() == 0


def test_a_round_of_components_lets_shuffle_files_go(spark, monkeypatch):
    import glob
    import time

    from monthplan.llm import components as cc

    folders = [d.getAbsolutePath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    forget, left = cc.forget_shuffles, []

    def shuffles():
        return {f.split("/")[-1].split("_")[1] for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}

    def counted(session):
        forget(session)
        time.sleep(1)
        left.append(len(shuffles() - before))

    monkeypatch.setattr(cc, "forget_shuffles", counted)
    before = shuffles()
    found = connected_components(spark.range(39).selectExpr("id AS a", "id + 1 AS b").repartition(8))
    assert [tuple(r) for r in found.selectExpr("count(*)", "max(component_id)").collect()] == [(40, 0)]
    assert len(left) > 2 and max(left) <= 8, left  # a round's own, not those of all rounds so far
