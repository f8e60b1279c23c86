"""Main text of web pages: boosted trees over DOM-node features, decoded along the tree.

Every element is described by its own markup (tag, tokens of class, id and role), its subtree (text, links, tags and
punctuation by length), its place (depth, position, siblings) and what stands above it. The trees give the chance that
its text belongs to the article. Decoding then picks, from the leaves up, the best of three states for each subtree:
all kept, all dropped, or mixed at a price; so no element is kept inside a dropped one or dropped inside a kept one
without its ancestor being called mixed.

The trees learn from a bounded sample of the given pages, from those whose article the markup itself names. Because
few sites name it, each sampled page is also taken apart and put together anew under other markup (containers with
other tags and tokens, sidebars, notices, forms, comments with texts of other pages), with labels known by construction.
Pages that name no article are sampled as well, and learnt from with their densest text subtree as a weak label.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import escape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosted_trees import BoostedTrees
from .dom import Node, blocks, parse
from .tables import read_table, ship_package, text_pieces

SAMPLE_PAGES = 240  # pages that name their article, for fitting the trees, by the order of a hash
WEAK_PAGES = 120  # the same of pages that name none
WEAK_LEAST = 200  # characters of a weak article, less the prices of what stands in it
WEAK_TAG = 20  # price of an element there, in characters
SAMPLE_CHARS = 100_000  # longer pages are left out of the sample, never cut
VARIANTS = 3
MIXED = 1.0  # price of a mixed subtree, in log-odds

TOKENS = {
    "content": "article articlebody body content entry main maintext post postbody story text prose page hentry",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumbs toc tabs pager pagination skip links topbar toolbar",
    "advert": "ad ads adv advert advertisement adsense banner sponsor sponsored promo promoted promotion commercial outbrain taboola",
    "comment": "comment comments commentlist reply replies respond disqus discussion reviews feedback reader",
    "aside": "aside sidebar side rail related recommended recommendations popular trending widget widgets teaser more latest",
    "frame": "footer foot header head masthead copyright colophon legal imprint site bottom top logo branding",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay banner warning paywall message disclaimer",
    "form": "form login signup signin subscribe subscription newsletter search register share sharing social follow contact",
}
_GROUP = {word: name for name, words in TOKENS.items() for word in words.split()}
_NAMES = list(TOKENS)
_TAGS = {t: k for k, group in enumerate((
    "p blockquote pre figcaption", "h1 h2 h3 h4 h5 h6", "ul ol dl menu dir", "li dt dd", "a", "div", "section", "article main",
    "nav", "aside", "header footer", "form fieldset label input legend", "table tbody thead tfoot tr td th",
    "b i em strong span u small code sub sup font")) for t in group.split()}
_N_TAGS = max(_TAGS.values()) + 2
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_ABOVE = ("nav", "aside", "header", "footer", "form", "article", "main")


def features(nodes: list[Node]) -> np.ndarray:
    """One row an element, in page order."""
    n = len(nodes)
    own, links, marks, words, tags, paras = (np.zeros(n) for _ in range(6))
    tokens = np.zeros((n, len(_NAMES)))
    above = np.zeros((n, len(_NAMES)))
    under = np.zeros((n, len(_ABOVE)))
    in_link = np.zeros(n, bool)
    kind = np.full(n, _N_TAGS - 1)
    sibling, siblings = np.zeros(n), np.ones(n)
    for i, node in enumerate(nodes):
        up = node.parent
        kind[i] = _TAGS.get(node.tag, _N_TAGS - 1)
        if node.raw:
            attributes = node.attributes()
            for key in ("class", "id", "role", "itemprop", "aria-label"):
                for token in _SPLIT.split(attributes.get(key, "")):
                    token = token.lower()
                    name = _GROUP.get(token) or _GROUP.get(token.rstrip("s"))
                    if name:
                        tokens[i, _NAMES.index(name)] = 1
        if up >= 0:
            above[i] = np.maximum(above[up], tokens[up])
            under[i] = under[up]
            in_link[i] = in_link[up]
        if node.tag in _ABOVE:
            under[i, _ABOVE.index(node.tag)] = 1
        in_link[i] |= node.tag == "a"
        children = [c for c in node.inside if isinstance(c, int)]
        for k, c in enumerate(children):
            sibling[c], siblings[c] = k, len(children)
        if node.unseen:
            continue
        tags[i] = 1
        paras[i] = node.tag == "p"
        for part in node.inside:
            if isinstance(part, str):
                text = part.strip()
                own[i] += len(text)
                words[i] += text.count(" ") + bool(text)
                marks[i] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
        if in_link[i]:
            links[i] = own[i]
    direct = own.copy()
    before = np.cumsum(direct) - direct
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        for sums in (own, links, marks, words, tags, paras):
            sums[up] += sums[i]
    total = max(own[0], 1.0)
    parent = np.array([max(x.parent, 0) for x in nodes])
    depth = np.array([x.depth for x in nodes], float)
    density = links / np.maximum(own, 1)
    near = np.zeros((n, 2))
    for node in nodes:
        children = [c for c in node.inside if isinstance(c, int)]
        for a, b in zip(children, children[1:], strict=False):
            near[a, 1], near[b, 0] = np.log1p(own[b]), np.log1p(own[a])
    return np.column_stack([
        np.eye(_N_TAGS)[kind], tokens, above, under, depth, np.log1p(own), np.log1p(direct), density, density[parent],
        marks / np.maximum(words, 1), own / np.maximum(tags, 1), words / np.maximum(tags, 1), np.log1p(tags), np.log1p(paras),
        own / total, own[parent] / total, before / total, (before + own) / total, sibling / siblings, np.log1p(siblings), near,
        np.eye(_N_TAGS)[kind[parent]],
    ]).astype(np.float32)


def decode(nodes: list[Node], logit: np.ndarray) -> list[bool]:
    """Whether each element's own text is kept: the best consistent choice of kept, dropped and mixed subtrees."""
    n = len(nodes)
    logit = np.clip(logit, -8, 8)
    own = np.array([sum(len(p.strip()) for p in x.inside if isinstance(p, str)) if not x.unseen else 0 for x in nodes], float)
    weight = np.where(own > 0, 1 + np.log1p(own), 0.25)
    weight[[x.unseen for x in nodes]] = 0
    gain = weight * logit / 2  # for keeping; its negative for dropping
    keep_all, drop_all = gain.copy(), -gain
    mixed = np.abs(np.where(own > 0, gain, 0))
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        best[i] = max(keep_all[i], drop_all[i], mixed[i] - MIXED)
        up = nodes[i].parent
        if up >= 0:
            keep_all[up] += keep_all[i]
            drop_all[up] += drop_all[i]
            mixed[up] += best[i]
    state: list[bool | None] = [None] * n
    keep = [False] * n
    for i, node in enumerate(nodes):
        said = state[node.parent] if node.parent >= 0 else None
        if said is None:
            if mixed[i] - MIXED > max(keep_all[i], drop_all[i]):
                keep[i] = bool(gain[i] > 0)
                continue
            said = bool(keep_all[i] > drop_all[i])
        state[i] = keep[i] = said
    return keep


def extract(html: str, model: BoostedTrees) -> str:
    """The main text: kept blocks in page order, two line breaks between them."""
    nodes = parse(html)
    return "\n\n".join(blocks(nodes, decode(nodes, model.logit(features(nodes)))))


# -- training -----------------------------------------------------------------------------------------------------

_DROP = frozenset("nav aside header footer form".split())


def _labelled(nodes: list[Node]) -> np.ndarray | None:
    """1 inside the article that the markup names, 0 outside, by element; None if it names none."""
    y = np.zeros(len(nodes))
    for i, node in enumerate(nodes):
        mark = node.attributes().get("data-main") if node.raw else None
        inherited = y[node.parent] if node.parent >= 0 else 0
        if mark is not None:
            y[i] = float(mark == "1")
        elif node.tag in ("article", "main") or (inherited and node.tag not in _DROP):
            y[i] = 1
    return y if y.any() else None


def _weak(nodes: list[Node]) -> np.ndarray | None:
    """The same by the densest text subtree, for a page that names no article: most text outside of links and of what
    is marked as no article, less a price for each element. None if there is too little."""
    n = len(nodes)
    own = np.array([0 if x.unseen else sum(len(p.strip()) for p in x.inside if isinstance(p, str)) for x in nodes], float)
    under = own.copy()
    for i in range(n - 1, 0, -1):
        under[nodes[i].parent] += under[i]
    out, links = np.zeros(n, bool), np.zeros(n, bool)
    for i, node in enumerate(nodes):
        if node.parent >= 0:
            out[i], links[i] = out[node.parent], links[node.parent]
        links[i] |= node.tag == "a"
        out[i] |= node.tag in _DROP
        if node.raw and 2 * under[i] < under[0]:  # a frame around the whole page may be called anything
            named = node.attributes()
            groups = {_GROUP.get(t.lower()) for key in ("class", "id", "role") for t in _SPLIT.split(named.get(key, ""))}
            out[i] |= bool(groups - {None, "content"})
    gain = np.where(out | links, -own, own) - np.array([0 if x.unseen else WEAK_TAG for x in nodes])
    for i in range(n - 1, 0, -1):
        gain[nodes[i].parent] += gain[i]
    best = int(np.argmax(np.where(out, -np.inf, gain)))
    if gain[best] < WEAK_LEAST:
        return None
    y = np.zeros(n)
    for i, node in enumerate(nodes):
        y[i] = float(i == best or (node.parent >= 0 and y[node.parent] and not out[i]))
    return y


class _Parts:
    """What a page is made of: its article's blocks, its heading, and the short texts around it."""

    def __init__(self, html: str):
        nodes = parse(html)
        y = _labelled(nodes)
        y = _weak(nodes) if y is None else y
        inside = [bool(y is not None and v) for v in (y if y is not None else np.zeros(len(nodes)))]
        self.article = blocks(nodes, inside)
        self.rest = blocks(nodes, [not v for v in inside])


def _rebuilt(parts: _Parts, others: list[_Parts], rng: random.Random) -> str:
    """A page with the same article under other markup, among other pages' texts as its surroundings."""

    def token(*groups: str) -> str:
        if rng.random() < 0.25:
            return ""
        word = rng.choice(TOKENS[rng.choice(groups)].split())
        word = rng.choice([word, f"{word}-{rng.choice(['wrap', 'box', 'inner', 'area', 'list'])}", f"site-{word}", word.title()])
        return f' {rng.choice(["class", "class", "id"])}="{word}"'

    def short(k: int) -> list[str]:
        found = [t for o in rng.sample(others, min(4, len(others))) for t in o.rest] or ["more"]
        return [escape(rng.choice(found)[:rng.choice([20, 60, 160])]) for _ in range(k)]

    def long(k: int) -> list[str]:
        found = [t for o in rng.sample(others, min(3, len(others))) for t in o.article] or ["more"]
        return [escape(rng.choice(found)[:rng.choice([80, 200, 600])]) for _ in range(k)]

    def links() -> str:
        items = [f'<a href="/{k}">{t[:30]}</a>' for k, t in enumerate(short(rng.randint(3, 9)))]
        return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def around(kind: str) -> str:
        if kind == "menu":
            tag, inner = rng.choice(["nav", "div", "div", "ul"]), links()
        elif kind == "comment":
            tag = rng.choice(["section", "div", "div", "ol"])
            inner = (f"<h3>{short(1)[0][:20]}</h3>" if rng.random() < 0.6 else "") + "".join(
                f'<div{token("comment")}><p>{t}</p></div>' for t in long(rng.randint(1, 5)))
            name = rng.choice(["comments", "comment-list", "discussion", "reader-comments", "respond", "replies"])
            return f'<{tag} data-main="0" {rng.choice(["class", "id"])}="{name}">{inner}</{tag}>'
        elif kind == "form":
            tag = rng.choice(["form", "form", "div"])
            inner = f"<label>{short(1)[0]}</label><input name=q><button>{short(1)[0][:12]}</button><p>{short(1)[0]}</p>"
        elif kind == "frame":
            tag, inner = rng.choice(["footer", "header", "div"]), "".join(f"<p>{t}</p>" for t in short(rng.randint(1, 3)))
            inner += links() if rng.random() < 0.4 else "&copy; " + short(1)[0]
        else:
            tag = rng.choice(["div", "div", "aside", "section"])
            inner = rng.choice([links(), "".join(f"<p>{t}</p>" for t in short(rng.randint(1, 3))), short(1)[0]])
        mark = token(kind)
        if not mark and tag in ("div", "section", "ul", "ol"):  # nothing would tell it but its text: leave it plain and short
            inner = inner if kind in ("menu", "form") else short(1)[0]
        return f'<{tag} data-main="0"{mark}>{inner}</{tag}>'

    kinds = ["menu", "advert", "comment", "aside", "frame", "notice", "form"]
    body = []
    for k, text in enumerate(parts.article):
        tag = "h1" if k == 0 and rng.random() < 0.7 else rng.choice(["p"] * 8 + ["h2", "blockquote", "div"])
        if k and rng.random() < 0.15 and " " in text:  # a list or a table of the article's own sentences
            items = [escape(t) for t in re.split(r"(?<=[.!?]) ", text) if t]
            item = rng.choice(["<li>{}</li>", "<li><p>{}</p></li>", "<tr><td>{}</td></tr>"])
            holder = "table" if "td" in item else rng.choice(["ul", "ol"])
            body.append(f"<{holder}>{''.join(item.format(t) for t in items)}</{holder}>")
            continue
        text = escape(text)
        if rng.random() < 0.2 and " " in text:
            a, b = text.split(" ", 1)
            text = rng.choice(['<a href="/x">{}</a> {}', "<b>{}</b> {}", "<em>{}</em><br>{}", "<span>{} {}</span>"]).format(a, b)
        body.append(f"<{tag}>{text}</{tag}>" if tag != "div" else f'<div{token("content")}>{text}</div>')
        if rng.random() < 0.12:
            body.append(around(rng.choice(["advert", "aside", "form", "notice"])))
    main = rng.choice(["article", "main", "div", "div", "section", "td"])
    article = f'<{main} data-main="1"{token("content")}>{"".join(body)}</{main}>'
    if main == "td":
        article = f"<table><tr>{article}</tr></table>"
    for _ in range(rng.randint(0, 2)):
        article = f"<div{token('content') if rng.random() < 0.5 else ''}>{article}</div>"
    first = [around(rng.choice(["menu", "frame", "advert", "notice", "form"])) for _ in range(rng.randint(0, 4))]
    last = [around(rng.choice(kinds)) for _ in range(rng.randint(0, 5))]
    head = f"<head><title>{short(1)[0]}</title><style>p{{}}</style></head>"
    return f"<html>{head}<body>{''.join(first)}{article}{''.join(last)}</body></html>"


def train(pages: list[str], seed: int = 11) -> BoostedTrees:
    """Fit on pages that name their article, or else by their densest text, as they are and rebuilt."""
    parts = [p for p in map(_Parts, pages) if p.article]
    rng = random.Random(seed)
    built = [_rebuilt(p, parts, rng) for p in parts for _ in range(VARIANTS)]
    x, y, w = [], [], []
    for html in [*pages, *built]:
        nodes = parse(html)
        label = _labelled(nodes)
        label = _weak(nodes) if label is None else label
        if label is None:
            continue
        x.append(features(nodes))
        y.append(label)
        w.append([0.0 if n.unseen else 1.0 if any(isinstance(p, str) and p.strip() for p in n.inside) else 0.3 for n in nodes])
    if not x:
        return BoostedTrees.fit(np.zeros((0, 1)), np.zeros(0), np.zeros(0))
    return BoostedTrees.fit(np.concatenate(x), np.concatenate(y), np.concatenate(w))


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> bytes:
    """The trees of a bounded sample of pages, fitted in one task; only they reach the driver."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{html_col}`").alias("html"))
    rows = rows.where(F.length("html") <= SAMPLE_CHARS)
    named = F.lower("html").rlike("<(article|main)[ >]")
    by = [F.xxhash64("page_id", F.lit("sample")), F.col("html")]
    sample = rows.where(named).orderBy(*by).limit(SAMPLE_PAGES).unionByName(rows.where(~named).orderBy(*by).limit(WEAK_PAGES))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [b for b in batches if len(b)]
        if found:
            yield pd.DataFrame({"model": [train(pd.concat(found).sort_values(["page_id", "html"])["html"].tolist()).dump()]})

    models = sample.repartition(1).mapInPandas(learn, "model binary").collect()
    return bytes(models[0]["model"]) if models else train([]).dump()


def main_text(pages: DataFrame, model: bytes, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row for each row of ``pages``.

    Null, empty and tagless pages are read like any other (null as empty); a page without an article gives the empty
    text; null ids and repeated rows pass through.
    """
    ship_package(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = BoostedTrees.load(shared.value)
        for piece in text_pieces(batches, "html"):
            pages_of = [parse(h) for h in piece.column(2).to_pylist()]
            rows_of = [features(p) for p in pages_of]
            logits = np.split(trees.logit(np.concatenate(rows_of)), np.cumsum([len(r) for r in rows_of])[:-1])
            texts = ["\n\n".join(blocks(p, decode(p, s))) for p, s in zip(pages_of, logits, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return main_text(pages, fit(pages))
