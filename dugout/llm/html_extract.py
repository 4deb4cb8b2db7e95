"""Main text of web pages by gradient-boosted trees over DOM nodes.

The trees are fitted by Spark ML on pages that training_pages() makes: a bounded number of them, TRAINING_PAGES, with
articles of known nodes among menus, headers, footers, sidebars, notices, adverts, forms and comments, some marked by
elements or attributes and some only by their shape. Each node of a page gets the log odds of being kept; hierarchical
decoding then takes the consistent choice with the largest sum: a node is only kept with all its ancestors, and
dropping one drops everything inside it.

Edge cases: a null or empty page, or one without kept text, has the text "" and 0 signs. Cut-off pages and unclosed
elements are read as far as they go, in time linear in the page. Nothing but scripts, styles, drawings, frames and lists of
choices is skipped unjudged; formulas, embedded objects and what stands in for them are nodes like others. Rows that repeat return as often; null ids and addresses stay null. An empty table
gives an empty result. Columns beyond the named ones are not read.

Fitted trees are kept as a table in the shared folder, under a name made of the settings and this code, so that they are
fitted once and not by each session.
"""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_dom
from .common import Scratch, plain, shared_folder, slices, table
from .html_dom import N_FEATURES, Page

TRAINING_PAGES, TREES, DEPTH = 2400, 50, 6
_models: dict[tuple, list[tuple]] = {}


def training_page(seed: int, whole: bool = False) -> tuple[str, list[str]]:
    """A page, and the texts of its kept blocks in order. Kept words begin with k, others with x. Some pages are cut off,
    unless `whole`."""
    rng = np.random.default_rng(seed)
    pick = lambda *xs: xs[rng.integers(len(xs))]
    chance = lambda p: rng.random() < p
    signs = np.array(list("abcdefghijklmnopqrstuvwyzäéñ"))

    def words(n: int, first: str) -> str:
        out = [first + "".join(rng.choice(signs, rng.integers(1, 9))) for _ in range(max(1, n))]
        return " ".join(w + (pick(".", ",", "?", ".") if chance(0.15) else "") for w in out)

    size = lambda most: int(rng.integers(1, most + 1) if chance(0.3) else rng.integers(most // 3 + 1, most + 1))
    marked = pick("tags", "attributes", "both", "attributes", "tags", "none")
    by_tag, by_attribute = marked in ("tags", "both"), marked in ("attributes", "both")
    box = lambda tag, names, inner: f"<{tag if by_tag else 'div'}{f' {pick("class", "id", "class")}="{pick(*names.split())}"' if by_attribute or (not by_tag and chance(0.3)) else ''}>{inner}</{tag if by_tag else 'div'}>"
    named = lambda names, inner, tag="div": f'<{tag} class="{pick(*names.split())}">{inner}</{tag}>'
    icon = lambda: pick("", "", "", "", '<svg class="icon"/>', '<svg viewBox="0 0 8 8"><path d="M0 0"/></svg>')
    link = lambda: f'<a href="/{words(1, "x")}">{icon()}{words(pick(1, 1, 2, 3), "x")}</a>'
    links = lambda n: pick(lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>", lambda: pick(" | ", " ", "").join(link() for _ in range(n)), lambda: "".join(f"<div>{link()}</div>" for _ in range(n)))()
    blurb = lambda most: pick(lambda: words(size(most), "x"), lambda: f"<p>{words(size(most), 'x')}</p>", lambda: f"<p>{words(size(most), 'x')} {link()}</p>")()

    def nav() -> str:
        return box("nav", "nav menu navbar main-nav topnav breadcrumb site-navigation", links(int(rng.integers(2, 9))))

    def header() -> str:
        return box("header", "header masthead site-header banner topbar", pick("", f"<h1>{words(2, 'x')}</h1>", f"<p>{words(5, 'x')}</p>", link()) + pick("", nav()) + pick(words(3, "x"), ""))

    def footer() -> str:
        return box("footer", "footer site-footer page-footer bottom copyright", pick("&copy; ", "") + blurb(25) + pick("", links(4)))

    def aside() -> str:
        return box("aside", "sidebar side-bar widget related-posts right-rail more", f"<{(h := pick('h2', 'h3', 'h4'))}>{words(2, 'x')}</{h}>" + pick(links(5), blurb(30), blurb(30) + links(3)))

    def advert() -> str:
        return named("ad ads advert ad-slot sponsored promo-box advertisement banner-ad", blurb(25))

    def notice() -> str:
        return named("cookie-notice notice cookie-banner gdpr alert consent popup message", blurb(30) + pick("", f"<button>{words(1, 'x')}</button>"), pick("div", "section", "div"))

    def form() -> str:
        inner = f"<label>{words(2, 'x')}</label><input type='text'>" + pick("", f"<p>{words(8, 'x')}</p>") + f"<button>{words(1, 'x')}</button>"
        return pick(f"<form action='/x'>{inner}</form>", named("newsletter subscribe search-form signup login", f"<form>{inner}</form>"))

    def comments() -> str:
        one = lambda: pick(named("comment comment-body reply", blurb(40)), f"<li>{blurb(40)}</li>")
        return named("comments comment-list discussion comments-area responses", pick("", f"<h3>{words(2, 'x')}</h3>") + "".join(one() for _ in range(int(rng.integers(1, 6)))) + pick("", form()), pick("div", "section"))

    def share() -> str:
        return named("share social-share share-tools", links(3))

    kept: list[str] = []

    def keep(n: int) -> str:
        text = words(n, "k")
        kept.append(text)
        return text

    # Class words that belong to other parts of a page as often as to an article.
    odd = lambda: pick(*"more-text top-story message warning response reply header-text side-note bottom-line tools author-note popular rail legal-news alert contact meta related-text notification tabs".split())

    def block() -> str:
        if chance(0.06):
            inner = pick(lambda: f"<p>{keep(size(60))}</p>", lambda: f"<p>{keep(size(40))}</p><p>{keep(size(40))}</p>", lambda: keep(size(60)))()
            return f"<{(t := pick('div', 'div', 'section', 'blockquote'))} class=\"{odd()}\">{inner}</{t}>"
        if chance(0.1):
            items = lambda n, one: f"<{(t := pick('ul', 'ol'))}>{''.join(f'<li>{one()}</li>' for _ in range(n))}</{t}>"
            return pick(
                lambda: items(int(rng.integers(3, 13)), lambda: f"<a href='/x'>{keep(pick(1, 2, 4))}</a>"),
                lambda: items(int(rng.integers(2, 8)), lambda: f"<a href='/x'>{keep(pick(1, 2))}</a> {keep(size(16))}"),
                lambda: f"<figure><img src='/x'><figcaption>{keep(size(16))}</figcaption></figure>",
                lambda: f"<{(t := pick('aside', 'blockquote', 'div'))} class=\"{pick('pullquote', 'pull-quote', 'quote')}\">{pick('', '<p>')}{keep(size(20))}</{t}>",
            )()
        kind = rng.integers(15)
        if kind < 7:
            return f"<p>{icon()}{keep(size(90))}{pick('</p>', '</p>', '')}"
        if kind == 14:  # formulas, embedded objects and what stands in for them
            return pick(
                lambda: f"<p>{keep(size(30))} <math><mi>{keep(1)}</mi> <mo>{keep(1)}</mo></math> {keep(size(10))}</p>",
                lambda: f"<object data='/x'><p>{keep(size(20))}</p></object>",
                lambda: f"<noscript>{keep(size(20))}</noscript>",
                lambda: f"<{(m := pick('video', 'audio', 'canvas'))}>{keep(size(12))}</{m}>",
            )()
        if kind == 7:
            return f"<p><b>{keep(size(60))}<br><p>"
        if kind == 8:
            return f"<h{(h := pick(2, 3))}>{keep(pick(2, 4, 8))}</h{h}>"
        if kind == 9:
            return "<ul>" + "".join(f"<li>{keep(size(25))}</li>" for _ in range(int(rng.integers(2, 6)))) + "</ul>"
        if kind == 10:
            return f"<blockquote>{pick(lambda: keep(size(40)), lambda: f'<p>{keep(size(40))}</p>')()}</blockquote>"
        if kind == 11:
            return f"<p>{keep(size(40))} <a href='/x'>{keep(2)}</a> {keep(size(20))}</p>"
        if kind == 12:
            return f"<div>{keep(size(80))}</div>"
        return "<table>" + "".join(f"<tr><td>{keep(3)}</td><td>{keep(2)}</td></tr>" for _ in range(2)) + "</table>"

    between = [advert, aside, share, notice, form]
    if chance(0.04):  # nothing but an article, or its text
        bare = pick(lambda: keep(size(60)), lambda: "".join(f"<p>{keep(size(60))}</p>" for _ in range(int(rng.integers(1, 6)))), lambda: f"<h1>{keep(4)}</h1>" + "".join(block() for _ in range(int(rng.integers(1, 6)))))()
        return pick(bare, f"<html><body>{bare}</body></html>", f"<html><head><title>{words(2, 'x')}</title></head><body>{bare}</body>"), kept
    body = [pick(lambda: f"<h1>{keep(pick(1, 3, 8))}</h1>", lambda: f"<h1>{keep(6)}</h1>", lambda: "", lambda: f"<header><h1>{keep(5)}</h1></header>" if marked == "tags" else f"<h2>{keep(5)}</h2>")()]
    short = chance(0.3)  # shorter than what stands around it
    if short:
        body.append(pick(lambda: f"<p>{keep(size(12))}</p>", lambda: f"<p><b>{keep(size(12))}<br>", lambda: f"<p><b>{keep(size(8))}<br><p>{keep(size(12))}</p>", lambda: keep(size(12)))())
    for _ in range(0 if short else int(rng.integers(1, 4) if chance(0.25) else rng.integers(3, 14))):
        body.append(block())
        if chance(0.08):
            body.append(between[rng.integers(len(between))]())
        if chance(0.05):
            body.append("<script>var x='</p>';</script>")
    if chance(0.1):  # what an article refers to
        head = pick(lambda: "", lambda: f"<h3>{keep(1)}</h3>")()
        notes = "".join(f"<li>{keep(size(12))} <a href='/x'>{keep(pick(1, 1, 3))}</a></li>" for _ in range(int(rng.integers(1, 7))))
        body.append(f"<{(t := pick('section', 'div', 'div'))} class=\"{pick('footnotes', 'references', 'notes', 'endnotes', 'sources')}\">{head}<ol>{notes}</ol></{t}>")
    if chance(0.06):
        body.append(comments())
    if chance(0.2):  # the article in sections
        cuts = sorted(rng.integers(1, len(body) + 1, int(rng.integers(1, 4))).tolist())
        parts = [body[a:z] for a, z in zip([0, *cuts], [*cuts, len(body)], strict=True) if z > a]
        kind = pick("section", "section", "div")
        body = [f"<{kind}>{''.join(p)}</{kind}>" for p in parts]
    text = "".join(body)
    holder = pick("article", "main", "article") if by_tag or chance(0.2) else "div"
    good = pick("article", "content", "post-body", "entry-content", "main-content", "story", "story-body")
    good = pick(f"{good} {odd()}", f"{odd()} {good}") if chance(0.3) else good
    name = f' class="{good}"' if by_attribute or chance(0.25) else ""
    if not chance(0.12):  # else the blocks stand beside the rest of the page
        text = f"<{holder}{name}>{text}</{holder}>"
    if chance(0.3):
        text = f"<main>{text}</main>" if by_tag else f'<div{pick("", " id=wrapper", " class=main")}>{text}</div>'
    top = [f() for f, p in ((notice, 0.2), (header, 0.45), (nav, 0.75), (form, 0.1), (advert, 0.5), (aside, 0.15)) if chance(p)]
    end = [f() for f, p in ((share, 0.2), (comments, 0.3), (aside, 0.35), (advert, 0.25), (form, 0.15), (nav, 0.1), (footer, 0.8), (notice, 0.15)) if chance(p)]
    inner = "".join(top) + text + "".join(end)
    if chance(0.2):
        inner = f'<div class="{pick("page", "wrapper", "container", "site")}">{inner}</div>'
    page = f"<!DOCTYPE html><html><head><title>{words(4, 'x')}</title><style>p{{}}</style></head><body>{inner}</body></html>"
    return (page[: int(len(page) * rng.uniform(0.5, 1))] if not whole and chance(0.1) else page), kept


def training_rows(page: str) -> tuple[list[list[float]], list[float]]:
    """Features and labels of the page's nodes: kept are those with a kept word inside and none, or few, others."""
    read = Page(page)
    rows = read.features()
    good, bad = [0] * len(rows), [0] * len(rows)
    for node, _, raw in read.pieces:
        for word in raw.split():
            if word[0] == "k":
                good[node] += 1
            elif word[0] == "x":
                bad[node] += 1
    number = {id(node): i for i, node in enumerate(read.nodes)}
    for i in range(len(rows) - 1, 0, -1):
        up = number[id(read.nodes[i].parent)]
        good[up] += good[i]
        bad[up] += bad[i]
    used = [i for i in range(len(rows)) if good[i] or bad[i]]
    return [rows[i] for i in used], [float(good[i] > 0) for i in used]


def fit(spark: SparkSession, pages: int = TRAINING_PAGES, trees: int = TREES, depth: int = DEPTH) -> list[tuple]:
    """The boosted trees as arrays (feature, threshold, left, right, value), from the shared folder if they are there."""
    code = inspect.getsource(html_dom) + inspect.getsource(training_page) + inspect.getsource(training_rows)
    name = hashlib.sha256(f"{pages} {trees} {depth} {code}".encode()).hexdigest()[:32]
    key = (spark.sparkContext.applicationId, name)
    if key not in _models:
        path = f"{shared_folder(spark)}/html_extract-trees-{name}"
        there = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
            fitted = [(i, n, *(float(x) for x in row)) for i, tree in enumerate(_fit(spark, pages, trees, depth)) for n, row in enumerate(zip(*tree, strict=True))]
            # Two sessions that fit at once write the same rows.
            spark.createDataFrame(fitted, "tree int, node int, feature double, threshold double, lower double, upper double, value double").coalesce(1).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])  # at most trees * 2 ** (depth + 1)
        _models[key] = [(t["feature"].to_numpy(np.int64), t["threshold"].to_numpy(), t["lower"].to_numpy(np.int64), t["upper"].to_numpy(np.int64), t["value"].to_numpy()) for _, t in rows.groupby("tree")]
    return _models[key]


def _fit(spark: SparkSession, pages: int, trees: int, depth: int) -> list[tuple]:

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for seed in batch.column("id").to_pylist():
                x, y = training_rows(training_page(seed)[0])
                rows += x
                labels += y
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(labels, pa.float64())], names=["x", "label"])

    made = spark.range(0, pages, 1, 4).mapInArrow(make, "x array<double>, label double")
    scratch = Scratch(spark, "html_extract")
    training = scratch.save(made, "training")
    rows = training.select(array_to_vector("x").alias("features"), "label")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=1, maxBins=32).fit(rows)
    out = []
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        nodes: list[list[float]] = []

        def walk(node, weight: float, nodes: list[list[float]] = nodes) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, at, at, 2 * weight * node.prediction()])
            if node.getClass().getSimpleName() == "InternalNode":
                nodes[at][:2] = [node.split().featureIndex(), node.split().threshold()]
                nodes[at][2] = walk(node.leftChild(), weight)
                nodes[at][3] = walk(node.rightChild(), weight)
            return at

        walk(tree._call_java("rootNode"), weight)
        cols = list(zip(*nodes, strict=True))
        out.append((np.array(cols[0], dtype=np.int64), np.array(cols[1]), np.array(cols[2], dtype=np.int64), np.array(cols[3], dtype=np.int64), np.array(cols[4])))
    scratch.drop(training)
    return out


def scores(trees: list[tuple], x: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Log odds of each row of x."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(depth):
            at = np.where(feature[at] < 0, at, np.where(x[rows, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at]))
        total += value[at]
    return total


#: Nodes whose features are held at once, whatever the pages' sizes.
NODES_AT_ONCE = 1 << 14


def log_odds(pages: list[Page], trees: list[tuple]) -> list[float]:
    """Of all nodes of the pages, in order."""
    rows, out = (row for page in pages for row in page.rows()), []
    while part := list(islice(rows, NODES_AT_ONCE)):
        out += scores(trees, np.array(part)).tolist()
    return out


def extract(pages: DataFrame, trees: list[tuple], keys: list[str]) -> DataFrame:
    """(*keys, text) of pages(*keys, html)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, sources in slices(batch, "html"):
                found = [Page(h.decode("utf-8", "replace")) for h in sources]
                odds, texts, start = log_odds(found, trees), [], 0
                for p in found:
                    texts.append(p.text(p.decode(odds[start : start + len(p.nodes)])))
                    start += len(p.nodes)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(first, last - first) for k in keys), pa.array(texts, pa.string())], names=[*keys, "text"])

    types = dict(pages.dtypes)
    return pages.select(*keys, "html").mapInArrow(read, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "text string"]))


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = plain(table(spark, sf_dir, "pages"), page_id="page_id", url="url", html="html")
    return extract(pages, fit(spark), ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))
