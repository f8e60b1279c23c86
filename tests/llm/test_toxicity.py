import zlib

import numpy as np
from conftest import MEDIUM
from helpers import rows
from monthplan.llm import toxicity as tx
from monthplan.llm import toxicity_model as tm


def test_gradients_are_those_of_the_loss():
    net = tm.Network.fresh()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, grams, per_word, counts = tm._inputs(["one two three four fivefold " * 9, "a bc def"])
    first, length, _ = tm._windows(counts)
    target, weight = np.arange(len(first)) % 2.0, np.ones(len(first))
    args = (words, grams, per_word, first, length, target, weight)
    _, g = net.gradients(*args)
    for name in ("in0", "in1", "zr0", "c1", "v", "w", "bias0"):
        at = tuple(0 for _ in net.p[name].shape)
        net.p[name][at] += 1e-4
        up, _ = net.gradients(*args)
        net.p[name][at] -= 2e-4
        down, _ = net.gradients(*args)
        net.p[name][at] += 1e-4
        assert abs((up - down) / 2e-4 - g[name][at]) < 1e-6 + 1e-3 * abs(g[name][at]), name


def test_a_window_begins_at_every_word():
    counts = np.array([0, 1, 7, 8, 9, 30])
    first, length, text = tm._windows(counts)
    plain = [(b + i, min(n, tm.WINDOW), t) for t, (b, n) in enumerate(zip(np.cumsum(counts) - counts, counts, strict=True))
             for i in range(max(1, n - tm.WINDOW + 1)) if n]
    assert list(zip(first.tolist(), length.tolist(), text.tolist(), strict=True)) == plain


def plain_score(net, text):
    """One window, one word and one step at a time, in doubles."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, grams, per_word, _ = tm._inputs([text])
    ends = np.cumsum(per_word)
    x = [np.r_[p["word"][w], p["gram"][grams[e - n:e]].sum(axis=0)] for w, e, n in zip(words, ends, per_word, strict=True)]
    best = -np.inf if len(x) else p["b"][0]
    for begin in range(max(1, len(x) - tm.WINDOW + 1) if len(x) else 0):
        window = x[begin:begin + tm.WINDOW]
        sides = []
        for k, order in (("0", range(len(window))), ("1", range(len(window) - 1, -1, -1))):
            h, states = np.zeros(tm.HIDDEN), {}
            for t in order:
                g = window[t] @ p[f"in{k}"] + p[f"bias{k}"]
                z, r = np.split(1 / (1 + np.exp(-(g[:2 * tm.HIDDEN] + h @ p[f"zr{k}"]))), 2)
                h = (1 - z) * h + z * np.tanh(g[2 * tm.HIDDEN:] + (r * h) @ p[f"c{k}"])
                states[t] = h
            sides.append(states)
        states = np.array([np.r_[sides[0][t], sides[1][t]] for t in range(len(window))])
        e = np.exp(states @ p["v"])
        best = max(best, (e / e.sum()) @ states @ p["w"] + p["b"][0])
    return 1 / (1 + np.exp(-(p["platt"][0] * best + p["platt"][1])))


def small_model(seed=4):
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(["one", "two", "three", "four", "five", "six"], 20)) + (" scumbag" if i % 3 == 0 else "") for i in range(200)]
    return tm.train(texts, (np.arange(200) % 3 == 0).astype(int), 0.3), rng


def test_scores_are_those_of_a_plain_forward_pass_over_all_windows():
    net, rng = small_model()
    words = ["one", "two", "Three", "scum", "scumbag", "caf\u00e9", "x", "a-b", "99", "..."]
    texts = [" ".join(rng.choice(words, int(n))) for n in (0, 1, 2, 7, 8, 9, 20, 60)] + ["", "!!", "one " * 30 + "scumbag"]
    assert np.allclose(net.scores(texts), [plain_score(net, t) for t in texts], atol=1e-4)


def test_a_word_is_the_same_input_beside_any_other():
    one, _, _, _ = tm._inputs(["scumbag"])
    many, grams, per_word, counts = tm._inputs(["Scumbag x", "a scumbag", "scumbag, two", "scumbag"])
    assert counts.tolist() == [2, 2, 2, 1] and (many[[0, 3, 4, 6]] == one[0]).all()
    assert len(set(many.tolist())) == 4 and len(grams) == per_word.sum()


def test_a_passage_scores_alike_wherever_it_stands():
    net, rng = small_model()
    passage = " ".join(rng.choice(["one", "six", "scumbag", "rest"], 24))
    alone = net.scores([passage])[0]
    placed = net.scores([" ".join(["two"] * k + [passage] + ["four"] * (40 - k)) for k in range(41)])
    assert (placed >= alone - 1e-5).all()


def test_learns_stems_and_words_in_long_texts():
    rng = np.random.default_rng(2)

    def text(toxic, n):
        words = [f"{rng.choice(list('bdfgk'))}{rng.choice(list('aeiou'))}{rng.integers(1000)}" for _ in range(n)]
        if toxic:
            words[rng.integers(n)] = rng.choice(["scumbag", f"vile{rng.integers(99)}"])
        return " ".join(words)

    labels = np.arange(900) % 3 == 0
    texts = [text(t, int(rng.integers(20, 200))) for t in labels]
    net = tm.train(texts[:700], labels[:700].astype(int), 0.3)
    assert ((net.scores(texts[700:]) >= 0.3) == labels[700:]).mean() > 0.9


def test_held_out_rows(spark):
    got = tx.op3_toxicity(spark, MEDIUM).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    assert (both.predicted == both.toxic).mean() > 0.85  # some labels of this table are noise


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (2, "", 9), (None, "some words", 9), (3, "!!! ...", 9), (4, "x " * 100_000, 9)],
                                 "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = tx.fit(docs.select("doc_id", "text"), tx.learnable(none))
    got = rows(tx.score(docs, model), "doc_id", "predicted")
    assert got == [(1, 0), (2, 0), (2, 0), (3, 0), (4, 0), (None, 0)]
    assert tx.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    assert rows(tx.learnable(labels), "doc_id", "toxic") == ([(1, 1)] if zlib.crc32(b"1") % 4 != 2 else [])
