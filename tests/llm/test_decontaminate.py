"""Decontamination against looking at every window of every item in every document."""

import random
import re

import pytest
from helpers import rows
from monthplan.llm import decontaminate as dc

WORD = re.compile(dc.WORD)


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = split(text)
        hit, named = set(), set()
        for item_id, item in items:
            v = split(item)
            size = min(window, len(v))
            for p in range(len(v) - size + 1 if v else 0):
                for at in range(len(w) - size + 1):
                    if w[at:at + size] == v[p:p + size]:
                        hit |= set(range(at, at + size))
                        named |= {str(item_id)} if item_id is not None else set()
        out.append((doc_id, len(w), len(hit), sorted(named), len(named), bool(hit)))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_words int, digest string")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, start int")
    return rows(dc.decontaminate(d, b, **options), "doc_id", "n_words", "n_hit", "items", "n_items", "contaminated")


def corpus(seed, n_docs=60, vocabulary=12):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["été", "Ünder", "ÉTÉ"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 7, 10, 11, 25]))) for i in range(14)]
    docs = []
    for i in range(n_docs):
        parts = [text(rng.randint(0, 30)) for _ in range(3)]
        if rng.random() < 0.6:
            item = rng.choice(items)[1].split()
            at = rng.randint(0, len(item) - 1)
            parts.insert(1, ", ".join(item[at:]).upper() if rng.random() < 0.3 else "\n".join(item[at:]))
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_every_window(spark, seed):
    docs, items = corpus(seed)
    assert found(spark, docs, items) == plain(docs, items)


def test_blocks_of_the_query_set_give_the_same(spark):
    docs, items = corpus(3, 30)
    assert found(spark, docs, items, block_rows=7) == plain(docs, items)


def test_odd_rows(spark):
    ten = "a b c d e f g h i j"
    docs = [(1, None), (None, ten), (2, ""), (2, ten + " k"), (2, ten), (3, "x " + ten.upper() + " y"), (4, "ha " * 40), (5, "a b c"), (6, "É É É")]
    items = [(1, ten), (1, "zz"), (None, "a b c"), (7, None), (8, "..."), (9, "ha " * 12), (10, "ha"), (11, ten), (12, "é é é")]
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, []) == plain(docs, [])
    assert found(spark, [], items) == []


def test_a_long_text_and_a_window_that_a_third_holds(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"{i} {passage} tail" if i % 3 == 0 else f"{i} other words only") for i in range(90)]
    docs.append((999, "the " * 200_000 + passage))
    items = [(i, passage) for i in range(5)] + [(9, "the the the the the the the the the the the")]
    got = {r[0]: r[1:] for r in found(spark, docs, items)}
    assert got[0] == (32, 30, ["0", "1", "2", "3", "4"], 5, True) and got[1] == (4, 0, [], 0, False)
    assert got[999] == (200_030, 200_030, ["0", "1", "2", "3", "4", "9"], 6, True)


def test_main_path_has_no_python(spark):
    docs, items = corpus(4, 5)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    plan = dc.occurrences(d.select(dc.F.lit(0).alias("row"), "doc_id", dc.words(dc.F.col("text")).alias("words")).withColumn(
        "n_words", dc.F.size("words")), dc.prefixes(dc.item_windows(spark.createDataFrame(items, "item_id long, text string"))[0],
                                                    spark.createDataFrame([(1, 1)], "token long, seen long")), [1, 4])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert not any(name in plan for name in ("MapInPandas", "MapInArrow", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"))
