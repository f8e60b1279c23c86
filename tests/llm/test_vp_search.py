import numpy as np
import pytest
from helpers import rows
from monthplan.llm import vp_search as vp


def brute(ids, x, queries, k):
    out = []
    for q in queries:
        scores = [(-float(np.cumsum(x[j] * x[q])[-1]), int(ids[j])) for j in range(len(ids)) if ids[j] != ids[q]]
        out += [(int(ids[q]), r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def data(n=600, dim=8):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((n, dim)) * rng.choice([0.5, 1, 3], n)[:, None]
    x[100:180] = x[100]  # ties
    return np.arange(n) * 3, x


def test_factor_one_is_exact_with_ties(spark):
    ids, x = data()
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    asked = frame.where("vec_id % 20 = 0")
    got = vp.search(frame, asked, k=20, shard_rows=150)
    assert rows(got, "query_id", "rank", "vec_id", "score") == brute(ids, x, [j for j in range(len(ids)) if ids[j] % 20 == 0], 20)


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (0.6, 0.9), (0.2, 0.3)])
def test_smaller_factors_look_at_less(factor, least):
    ids, x = data(3000)
    tree = vp.VpTree.load(vp.VpTree.build(ids, x, leaf=32).dump())
    q = np.arange(0, 3000, 60)
    want = brute(ids, x, q, 10)
    found = []
    for query, got, scores in tree.search(ids[q], x[q], 10, factor):
        best = np.lexsort((got, -scores))[:10]
        found += [(int(query), int(i)) for i in got[best]]
    recall = len(set(found) & {(a, i) for a, _, i, _ in want}) / len(want)
    assert recall >= least


def test_edges(spark):
    nan = float("nan")
    rows_in = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 0.0]), (2, None), (3, []), (4, [nan, 0.0]), (5, [0.0, 0.0]),
               (6, [None, 1.0]), (None, [5.0, 5.0]), (7, [1.0, 0.0]), (8, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows_in], "vec_id long, embedding array<double>, rank int")
    got = vp.search(frame, frame.where("vec_id % 20 = 0"), k=3)
    assert rows(got, "query_id", "rank", "vec_id", "score") == [
        (0, 1, 1, 2.0), (0, 2, 7, 1.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 7, 0.0)]
    assert vp.search(frame.limit(0), frame.limit(0)).count() == 0
