"""Every stage on its own input, against plain versions of what it decides."""

import corpus_pipeline as cp
import public_tokenizers as P
import pytest
from conftest import SMALL
from helpers import components, repeats
from monthplan.llm import secret_scan as sc
from monthplan.llm import toxicity as tx
from monthplan.llm.tables import stored
from test_near_duplicates import plain_sets


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], SMALL), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "repeats", "secrets", "packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert df.where("n_chars <> length(text)").count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    scored = tx.score(stages[0], tx.fitted(spark, SMALL)).where("predicted = 0")
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if i in {r.doc_id for r in scored.collect()}}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    sets = {i: plain_sets(t) for i, t in before.items()}
    ids = sorted(before)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    top = components(ids, links)
    assert texts(stages[2]) == {i: before[i] for i in ids if top[i] == i}


def test_repeated_windows_go(stages):
    before = texts(stages[2])
    want = {i: v[3].decode("utf-8", "replace") for i, v in repeats(before, 100).items() if not 0 < v[0] == v[1]}
    assert texts(stages[3]) == want


def test_secrets_are_masked_and_documents_stay(stages):
    want = {i: sc.mask(t, sorted(sc.base_spans(t) + sc.method_spans(t))) for i, t in texts(stages[3]).items()}
    assert texts(stages[4]) == want


def test_every_token_is_packed(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(stages[4]).items()}
    got = {}
    for r in stages[5].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


def test_stages_take_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int"
    odd = spark.createDataFrame([(1, None, None, None, None, 1), (None, "", "en", "s", 0, 1), (2, "a b", None, "s", 3, 1), (2, "a b", None, "s", 3, 1)], schema)
    for name, stage in cp.STAGES:
        odd = stored(stage(spark, odd, SMALL), f"odd-{name}")
    assert odd.select("doc_id").distinct().count() == 3
    empty = spark.createDataFrame([], schema)
    for name, stage in cp.STAGES:
        empty = stored(stage(spark, empty, SMALL), f"empty-{name}")
    assert empty.count() == 0
