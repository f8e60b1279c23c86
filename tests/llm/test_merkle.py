"""The manifest against a plain tree, row by row."""

import zlib
from hashlib import sha256

import pytest
from helpers import rows
from monthplan.llm import merkle as mk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return h(*[field(v) for v in (doc_id, source, lang, n_chars, text)])


def up(level):
    return [h(*level[i:i + 2]) for i in range(0, len(level), 2)]


def way(levels, at):
    """(side, sibling) from place ``at`` up."""
    out = []
    for level in levels[:-1]:
        run = level[at - at % 2:at - at % 2 + 2]
        out.append(("", "") if len(run) == 1 else ("L", run[0]) if at % 2 else ("R", run[1]))
        at //= 2
    return out


def tower(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def plain(table):
    by_lang = {}
    for r in table:
        by_lang.setdefault(r[2], []).append((r, leaf(*r[:5])))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    towers = {}
    for k in langs:
        by_lang[k].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        towers[k] = tower([x[1] for x in by_lang[k]])
    top = tower([towers[k][-1][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for at, (r, digest) in enumerate(by_lang[k]):
            steps = way(towers[k], at) + way(top, place)
            acc = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                acc = leaf(*r[:4], r[4] + 1)
            for side, other in steps:
                acc = h(other, acc) if side == "L" else h(acc, other)
            root = top[-1][0]
            out.append((r[0], digest, towers[k][-1][0], root, h(*[s for _, s in steps]), acc, acc == root))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def got(spark, table):
    return rows(mk.manifest(spark.createDataFrame(table, SCHEMA)),
                "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("counts", [{"a": 1}, {"a": 2}, {"a": 3, "b": 1}, {"a": 5, None: 4, "": 1},
                                    {"é": 17, "z": 9, "a": 2, None: 1, "b": 3}])
def test_small_trees(spark, counts):
    table, i = [], 0
    for lang, n in counts.items():
        for _ in range(n):
            table.append((i * 37 % 101, f"text {i} é", lang, "s", 10 + i, 0))
            i += 1
    assert got(spark, table) == plain(table)


def test_blocks_and_languages_of_very_different_depth(spark):
    # more than two blocks in one language, one row past a block in another, many small ones
    table = [(i, f"t{i}", "big", "s", i, 0) for i in range(2500)]
    table += [(10_000 + i, f"t{i}", "edge", "s", i, 0) for i in range(1025)]
    table += [(20_000 + i, f"t{i}", f"l{i % 9}", "s", i, 0) for i in range(40)]
    found = got(spark, table)
    assert found == plain(table)
    assert {r[6] for r in found} == {True, False}


def test_nulls_repeats_and_ties(spark):
    table = [(None, "x", "a", None, 1, 0), (None, None, None, None, None, 0), (3, "", "a", "s", None, 0)]
    table += [(8, "same", "a", "s", 4, 0)] * 9 + [(8, f"other {i}", "a", "s", 2 ** 63 - 1, 0) for i in range(3)]
    assert got(spark, table) == plain(table)


def test_proof_holds_the_siblings_in_order(spark):
    table = [(i, f"t{i}", "a", "s", i, 0) for i in range(6)]
    level = [leaf(*r[:5]) for r in table]
    proofs = {r.doc_id: r.proof for r in mk.manifest(spark.createDataFrame(table, SCHEMA)).collect()}
    a, b, c = up(level)
    assert proofs[0] == [level[1], b, up([a, b, c])[1]]
    assert proofs[5] == [level[4], up([a, b])[0]]  # c stands alone on its level


def test_long_text_and_empty_table(spark):
    table = [(1, "é" * 3_000_000, "a", "s", 3_000_000, 0), (2, "b", "a", "s", 1, 0)]
    assert got(spark, table) == plain(table)
    assert mk.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
