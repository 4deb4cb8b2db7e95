"""Extraction, mixing, chat, search, packing, language and the pipeline."""

import hashlib
import html
import itertools
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dugout.llm import ann_search, chat_format, html_extract, language_id, mixing, packing
from dugout.llm.html_dom import Page

SF = "/root/testdata/sf0.001"


# --- HTML ----------------------------------------------------------------------------------------------------------


def test_extract_held_out(spark):
    """Against the texts that the generator put in, not those that the reader saw."""
    trees = html_extract.fit(spark)
    right = wrong = missed = total = 0
    for seed in range(5_000_000, 5_000_200):
        source, kept = html_extract.training_page(seed, whole=True)
        page = Page(source)
        got = page.text(page.decode(html_extract.scores(trees, np.array(page.features())).tolist())).split()
        want = " ".join(kept).split()
        good = sum(w[0] == "k" for w in got)
        right, wrong, missed, total = right + (got == want), wrong + len(got) - good, missed + len(want) - good, total + len(want)
    assert right >= 0.85 * 200 and wrong + missed < 0.02 * total


def test_extract_articles_of_the_table(spark):
    """The pages' own article elements, read off by pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html").collect()
    got = {r["page_id"]: r["text"] for r in html_extract.op1_html_extract(spark, "/root/testdata/sf0.01").collect()}
    seen = 0
    for r in pages:
        found = re.search(r"(?s)<article[^>]*>(.*?)</article>", r["html"] or "")
        if found and not re.search(r"<(?:nav|div|aside|form|script|style|section|!--)", found[1]):
            want = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?(?:b|i|a|em|strong|span|code)\b[^>]*>", "", found[1])))
            seen += 1
            assert got[r["page_id"]].split() == want.split()
    assert seen > 50


def test_reader_loses_no_text():
    whole = lambda source: (lambda p: p.text([True] * len(p.nodes)))(Page(source))
    assert whole('<p>one</p><svg class="i"/><p>two kept</p><p>three</p><svg></svg><p>four</p>') == "one two kept three four"
    assert whole("one <math><mi>x</mi></math> two<object><p>q</p></object><noscript>z</noscript><svg><title>t</title></svg> e <svg> <p>g</p></svg>") == "one x two q z e g"
    assert whole("a<iframe>b<p>c") == "ab c" and whole("<p>a</b></i>b</p>c") == "ab c"


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p title=it's>one</p><p>two</p><p>x</p><p title=it's>three</p><p>four</p>", "one two x three four"),
        ("<p>one</p><!--><p>two</p><!-- x --><p>three</p><!---><p>four</p><!-- y --!>five", "one two three four five"),
        ("auto<wbr>matic co<ruby>op<rt>er</rt></ruby>ate x<acronym>y</acronym>z n<nobr>o</nobr> so<my-word>me</my-word>thing im<img src=x>age", "automatic cooperate xyz no something image"),
        ("<a href=/x/>in</a><div data-u=/a/>one<p>two</p></div><div/>three<p/>four", "in one two three four"),
        ("one<svg><title>t</title><text x='1'>bar</text><text>chart</text></svg>two", "one bar chart two"),
        ('<p a="b>c" d=\'e>f\' g = "h">one</p><p i=j"k>two</p><p "l">three</p><p m=>four</p>', "one two three four"),
        ("a<br>b<hr>c<span>d</span>e 1 < 2 <3", "a b cde 1 < 2 <3"),
        ("<p>one</p><!doctype x><?php y ?></ z><p>two", "one two"),
    ],
)
def test_reader_follows_the_rules_of_html(source, text):
    page = Page(source)
    assert page.text([True] * len(page.nodes)) == text


MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/a'>About us</a></li></ul></nav>"
FOOT = "<footer><p>Copyright 2024 Some Paper. All rights reserved.</p><a href='/p'>Privacy</a></footer>"
PROSE = ("The council met on Monday to discuss the new bridge, which has been delayed twice.", "Residents said that the noise was, above all, a problem at night, and asked for a wall.", "A decision is expected in June, when the engineers will have finished their report on the site.")
PARAS = "".join(f"<p>{p}</p>" for p in PROSE)
TEN = "".join(f"<li><a href='/t{i}'>Tool number {i}</a></li>" for i in range(10))
CLAUSES = "".join(f"<li><a href='/t{i}'>Tool {i}</a>, which does one thing well and little else.</li>" for i in range(5))
#: Written by hand, not by the generator of training pages: what stands around the body, and the body.
SHAPES = {
    "link list": ("<article>{}</article>", f"<h1>Ten tools</h1>{PARAS}<ul>{TEN}</ul>"),
    "links with clauses": ("<article>{}</article>", f"<h1>Five tools</h1>{PARAS}<ul>{CLAUSES}</ul>"),
    "footnotes": ("<article>{}</article>", f"<h1>Bridge</h1>{PARAS}<section class='footnotes'><h2>Notes</h2><ol><li>Minutes of the meeting, page 3. <a href='#1'>Back</a></li><li>Report of the engineers, 2023. <a href='#2'>Back</a></li></ol></section>"),
    "misleading body": ("<div class='story-body more-text'>{}</div>", f"<h1>Bridge</h1>{PARAS}"),
    "misleading first": ("<div class='top-story'>{}</div>", f"<h1>Bridge</h1>{PARAS}"),
    "legal": ("<div class='legal-news article'>{}</div>", f"<h1>Bridge</h1>{PARAS}"),
    "boxed paragraph": ("<article class='story-body more-text'>{}</article>", f"<h1>Bridge</h1>{PARAS}<div class='message'><p>{PROSE[1]}</p></div>{PARAS}"),
    "response": ("<article>{}</article>", f"<h1>Bridge</h1>{PARAS}<blockquote class='response'><p>{PROSE[2]}</p></blockquote>{PARAS}"),
    "caption": ("<article>{}</article>", f"<h1>Bridge</h1><figure><img src='/b.jpg'><figcaption>The bridge in May.</figcaption></figure>{PARAS}"),
    "pull quote": ("<article>{}</article>", f"<h1>Bridge</h1>{PARAS}<aside class='pullquote'><p>The noise was a problem at night.</p></aside>{PARAS}"),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_articles_of_other_shapes_come_out_whole(spark, shape):
    around, body = SHAPES[shape]
    page = Page(f"<html><head><title>T</title></head><body>{MENU}{around.format(body)}{FOOT}</body></html>")
    got = page.text(page.decode(html_extract.log_odds([page], html_extract.fit(spark))))
    assert got.split() == re.sub(r"<[^>]*>", " ", re.sub(r"</?a\b[^>]*>", "", body)).split()


def test_features_of_a_huge_page_come_in_parts(spark, monkeypatch):
    trees, page = html_extract.fit(spark), Page("<p>some words here</p>" * 3000)
    whole = html_extract.log_odds([page, page], trees)
    monkeypatch.setattr(html_extract, "NODES_AT_ONCE", 100)
    assert html_extract.log_odds([page, page], trees) == whole and len(whole) == 2 * len(page.nodes)


@pytest.mark.parametrize("source", ["<div>{n}</x>{n}", "<iframe>{n}<p>a", "<svg>{n}<p>a", "<b><div>{s}</b>{n}", "<b><td>{s}<tr>{n}", '<a "{n}', "<!--{n}"])
def test_reader_takes_linear_time(source):
    """40,000 tags in seconds; a quadratic reader takes minutes."""
    start = time.monotonic()
    big = re.sub(r"((?:<[^<{]*))\{n\}", lambda m: m[1] * 40_000, source).replace("{s}", "<span>" * 40_000)
    Page(big).features()
    assert time.monotonic() - start < 20


def test_decode_is_the_best_consistent_choice():
    rng = random.Random(2)
    for _ in range(50):
        source = "<div>a<p>b</p><section>c<p>d</p><ul><li>e</li></ul></section></div>"
        page = Page(source)
        scores = [rng.uniform(-2, 2) for _ in page.nodes]
        number = {id(n): i for i, n in enumerate(page.nodes)}
        best = None
        for kept in itertools.product([False, True], repeat=len(page.nodes) - 1):
            kept = (True, *kept)
            if all(not k or kept[number[id(n.parent)]] for k, n in zip(kept[1:], page.nodes[1:], strict=True)):
                value = sum(s for s, k in zip(scores, kept, strict=True) if k)
                best = max(best or (-9e9, None), (value, kept))
        assert page.decode(scores) == list(best[1])


def test_extract_edge_cases(spark):
    article = "<article><h1>A &amp; B</h1><p>One  two<br>three &lt;b&gt; <b>fo</b>ur" + "<p>five, six. seven eight nine ten" * 3 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (4, "u", f"<body><nav><ul><li><a href=/x>x</a></ul></nav>{article}<footer>f</footer>"), (4, "u", f"<body>{article}"), (None, "u", "<script>var a='<p>x</p>'</script>")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extract(pages.select("page_id", "url", "html"), html_extract.fit(spark), ["page_id", "url"]).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 6 and by[1] == by[2] == by[3] == by[None] == ""
    assert by[4].startswith("A & B One two three <b> four five, six.") and "x" not in by[4].split() and not by[4].endswith(" f")
    assert html_extract.extract(pages.limit(0).select("page_id", "html"), html_extract.fit(spark), ["page_id"]).collect() == []


# --- mixing --------------------------------------------------------------------------------------------------------


def counted(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


SOURCES = [(i, "big", 10) for i in range(600)] + [(1000 + i, "mid", 10) for i in range(200)] + [(2000 + i, "small", 10) for i in range(50)] + [(3000, None, 40), (3001, "none", 0), (3002, "big", 0)]


def test_exponent_meets_targets(spark):
    p = np.array([0.7, 0.2, 0.1])
    shares = spark.createDataFrame([(float(x),) for x in p], "p double")
    for target in (0.9, 1.0, 1.05):
        w = p ** mixing.exponent(shares, target_entropy=target)
        w /= w.sum()
        assert -(w * np.log(w)).sum() == pytest.approx(target, abs=1e-4)
    a = mixing.exponent(shares, repetition=2.0)
    assert (0.7 / 0.1) ** (1 - a) == pytest.approx(2.0, abs=1e-4)
    assert mixing.exponent(shares, repetition=8.0) == 0.0 and mixing.exponent(shares, repetition=1.0) == pytest.approx(1.0)
    assert mixing.exponent(shares.limit(1), repetition=2.0) == 1.0


def test_mix_realises_weights(spark):
    rows = counted(spark, SOURCES)
    sources, _ = mixing.mixing_plan(rows, block_tokens=100)
    held = {r["source"]: r for r in sources.collect()}
    assert sum(r["weight"] for r in held.values()) == pytest.approx(1) and held["big"]["repeats"] == 1.0
    assert max(r["repeats"] for r in held.values()) == pytest.approx(2.0, abs=1e-3)
    out = mixing.mix(rows.withColumn("blocks", F.lit("mine")), rows, block_tokens=100).toPandas()
    assert set(out["doc_id"]) == {r[0] for r in SOURCES} and set(out["blocks"]) == {"mine"}
    for name in ("big", "mid", "small"):
        used = out[out["source"] == name]["n_tokens"].sum()
        assert abs(used - held[name]["repeats"] * held[name]["tokens"]) <= 200
        assert out[out["source"] == name].groupby(["doc_id", "mix_epoch"]).size().max() == 1
    assert out["mix_position"].between(0, 1).all()


@pytest.mark.parametrize("options", [{}, {"target_entropy": 1.0, "budget": 400_000}])
def test_mix_realises_weights_of_the_table(spark, options):
    """On documents, with production blocks: token shares within 1 % of all tokens of their targets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", mixing.n_tokens(F.col("text")).alias("n_tokens"))
    sources, _ = mixing.mixing_plan(docs, **options)
    want = {r["source"]: r["weight"] for r in sources.collect()}
    got = mixing.mix(docs, docs, **options).groupBy("source").agg(F.sum("n_tokens").alias("n")).toPandas().set_index("source")["n"]
    assert len(want) > 3 and all(abs(got[k] / got.sum() - w) < 0.01 for k, w in want.items())


def test_mix_small_sources_in_default_blocks(spark):
    """Sources far below block_tokens are cut too: equal weights give equal shares."""
    rows = counted(spark, [(i, "a", 100) for i in range(600)] + [(1000 + i, "b", 100) for i in range(400)] + [(None, "b", 5), (None, "b", 5), (None, None, 3)])
    out = mixing.mix(rows, rows, repetition=None, target_entropy=1.2).groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).toPandas().set_index("source")
    assert abs(out["n"]["a"] - out["n"]["b"]) < 400 and out["nulls"].sum() >= 3


def test_mix_ranges_give_the_same_totals(spark, monkeypatch):
    rows = counted(spark, SOURCES)
    whole = sorted(map(tuple, mixing.mix(rows, rows, block_tokens=30).collect()), key=str)
    monkeypatch.setattr(mixing, "RANGE", 7)
    assert sorted(map(tuple, mixing.mix(rows, rows, block_tokens=30).collect()), key=str) == whole


def test_mix_moves_no_documents_with_a_short_plan(spark, monkeypatch):
    """The plan goes to the documents, or both are shuffled where it is long; the rows are the same."""
    rows = counted(spark, SOURCES)
    by_plan = lambda df: df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")
    short = mixing.mix(rows, rows, block_tokens=30)
    monkeypatch.setattr(mixing, "MOST_SENT", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        long = mixing.mix(rows, rows, block_tokens=30)
        assert by_plan(long) > by_plan(short)
        assert sorted(map(tuple, short.collect()), key=str) == sorted(map(tuple, long.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_mix_budget_repeats_and_empty(spark):
    rows = counted(spark, SOURCES + SOURCES[:1])
    out = mixing.mix(rows, rows, budget=2000, target_entropy=1.0, block_tokens=50).toPandas()
    assert abs(out["n_tokens"].sum() - 2000) < 400
    assert mixing.mix(counted(spark, []), counted(spark, [])).collect() == []


# --- chat ----------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    bad = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\e\\l\\\\h", "### a: b", "", None, "é𝄞\n"]
    roles = ["user", "assistant", "system", None, "we:ird\n### ", "assistant"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(roles), rng.choice(bad)) for c in range(30) for t in range(rng.randint(1, 9))] + [(None, None, "assistant", "x"), (99, 1, "user", "a"), (99, 1, "user", "a"), (98, 1, "user", "x" * 200_000)]
    turns = spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat_format.format_conversations(turns)
    got = {r["conv_id"]: r["t"] for r in formatted.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t")).collect()}
    examples = chat_format.expand_prefix_targets(formatted).collect()
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
        assert [(t["role"], t["text"]) for t in got[conv]] == [(r, x) for _, r, x in own]
        mine = sorted((e for e in examples if e["conv_id"] == conv and e["example"]), key=lambda e: e["example"])
        replies = [e["text"][e["loss_start"] : e["loss_end"]].replace("\\h", "#").replace("\\l", "<").replace("\\e", "\\") for e in mine]
        assert replies == [x for _, r, x in own if r == "assistant"]
        assert all(b["text"].startswith(a["text"]) and len(b["text"]) == b["loss_end"] for a, b in itertools.pairwise(mine))
    assert chat_format.format_conversations(turns.limit(0)).collect() == []


def test_chat_many_turns_take_linear_time(spark):
    """A conversation of 20,000 turns, half of them replies, read back in seconds."""
    start = time.monotonic()
    turns = spark.range(20_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("# <t> "), F.col("id")).alias("text"))
    made = chat_format.format_conversations(turns)
    row = made.select(chat_format.read_trainable(F.col("formatted"), F.col("replies")).alias("r")).first()
    assert [x["reply"] for x in row["r"]] == [f"# <t> {i}" for i in range(1, 20_000, 2)]
    assert chat_format.expand_prefix_targets(made, texts=False).count() == 10_000 and time.monotonic() - start < 90


# --- search --------------------------------------------------------------------------------------------------------


def test_search_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 32))
    x[2000:2400] = x[2000] + rng.normal(size=(400, 32)) * 1e-3
    x[2500:2600] = x[2500]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann_search.nearest(df, df.where("vec_id % 50 = 0"), 5).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 3000, 50):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        want = np.lexsort((np.arange(3000), -s))[:5]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert list(mine["rank"]) == [1, 2, 3, 4, 5]
        assert np.allclose(mine["score"], s[mine["vec_id"]], atol=1e-9)
        hit += len(set(want) & set(mine["vec_id"]))
    assert hit >= 0.93 * 300
    twins = got[got["query_id"] == 2550].sort_values("rank")["vec_id"].tolist()
    assert twins == [2500, 2501, 2502, 2503, 2504]


def test_ann_repeated_rows_crowd_nobody_out(spark):
    """Every row twice, and one neighbour six times, with equal and with different vectors: five different ids still."""
    base = [(i, [1.0, i * 0.01, 0.5]) for i in range(40)]
    rows = base * 2 + [(1, [1.0, 0.01, 0.5])] * 6 + [(2, [1.0, 0.02 + j * 1e-4, 0.5]) for j in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_search.nearest(df, df.where("vec_id = 0").limit(1), 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4, 5] and [r["rank"] for r in got] == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("settings", [{"block": 40}, {"block": 40, "query_block": 7}, {"block": 40, "probed": 200}])
def test_search_in_small_blocks(spark, settings):
    """Hot pivots are cut and queries dealt; with every file probed and all reranked the answer is the exact one."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 8)), np.tile(rng.normal(size=(1, 8)), (200, 1)), rng.normal(size=(1, 8)) + rng.normal(size=(200, 8)) * 1e-2])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann_search.nearest(df, df.where("vec_id % 9 = 0"), 5, share=1.0, **settings).toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, len(x), 9):
        s = np.round(unit @ unit[q], 12)
        s[q] = -9
        mine = got[got["query_id"] == q].sort_values("rank")["vec_id"].tolist()
        hit += len(set(mine) & set(np.lexsort((np.arange(len(x)), -s))[:5].tolist()))
        assert len(mine) == 5
    assert hit == 5 * 78 if "probed" in settings else hit >= 0.95 * 5 * 78


def test_search_takes_components_of_any_size_and_clashing_columns(spark):
    rows = [(0, [1e200, 0.0], 9), (1, [1.0, 1.0], 9), (2, [1e200, 1e200], 9), (3, [-3e-310, 0.0], 9), (4, [1e-300, 1e-301], 9), (5, [0.0, -1e308], 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, near long")
    got = ann_search.nearest(df, df.where("vec_id = 0"), 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] in ([4, 1, 2, 5, 3], [4, 2, 1, 5, 3]) and [r["score"] for r in got] == pytest.approx([1 / math.hypot(1, 0.1), math.sqrt(0.5), math.sqrt(0.5), 0.0, -1.0])


def test_search_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 1.0]), (8, []), (0, [3.0, 0.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_search.nearest(df, df.where("vec_id % 50 = 0"), 5).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert ann_search.nearest(df.limit(0), df.limit(0), 5).collect() == []
    assert ann_search.nearest(df.where("vec_id = 3"), df, 5).collect() == []


# --- packing -------------------------------------------------------------------------------------------------------


def test_bounds_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        lengths = sorted(rng.sample(range(40), rng.randint(1, 8)))
        counts = [rng.randint(1, 9) for _ in lengths]
        k = rng.randint(1, 4)
        cost = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))  # noqa: E731, B023
        best = min(cost([*some, lengths[-1]]) for r in range(min(k, len(lengths))) for some in itertools.combinations(lengths[:-1], r))
        assert cost(packing.optimal_bounds(np.array(lengths), np.array(counts), k)) == best


def test_pack(spark):
    rng = random.Random(4)
    blanks = [" ", "\n", "\t ", "  "]
    text = lambda n: rng.choice(["", " ", "\n"]) + "".join(rng.choice(["w", "é𝄞", "ß9"]) + rng.choice(blanks) for _ in range(n))
    rows = [(i, text(rng.choice([0, 3, 17, 60, 61, 64, 128, 250]))) for i in range(700)] + [(5, "a b"), (5, "a b"), (None, "x y z"), (701, None)]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, batch string, start long")
    out = packing.pack(docs, context=64, buckets=3, budget=300, shard=50).toPandas()
    count = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    assert len(out) == sum(max(1, math.ceil(n / 64)) for n in count) and out["n_tokens"].sum() == sum(count)
    assert (out["padding"] == out["bucket"] - out["n_tokens"]).all() and (out["padding"] >= 0).all() and out["bucket"].nunique() == 3
    for (bucket, _), part in out.groupby(["bucket", "batch"]):
        assert sorted(part["slot"]) == list(range(len(part))) and len(part) * bucket <= 300
    sizes = out.groupby(["bucket", "batch"]).size().reset_index(name="n")
    assert all((part.sort_values("batch")["n"].iloc[:-1] == 300 // max(1, bucket)).all() for bucket, part in sizes.groupby("bucket"))
    held = dict(rows)
    for doc, part in out[(out["doc_id"] != 5) & out["doc_id"].notna()].groupby("doc_id"):
        part, whole = part.sort_values("piece"), held[doc] or ""
        cut = [whole[a:z] for a, z in zip(part["start"], part["end"], strict=True)]
        assert "".join(cut) == whole and [len(re.findall(r"[^\x20\x09-\x0D]+", c)) for c in cut] == list(part["n_tokens"])
    assert packing.pack(docs.limit(0)).collect() == []


# --- language ------------------------------------------------------------------------------------------------------


def test_language_accuracy_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known, rest = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1 and length(text) > 60")
    models = language_id.fit(language_id._labelled(known))
    evidence = language_id.documents_evidence(rest).withColumn("declared", F.lit(None).cast("string"))
    got = language_id.identify(evidence, models, ["doc_id", "row_key"]).join(rest, "doc_id")
    n, right, kept = got.agg(F.count("*"), F.count_if(F.col("language") == F.col("lang")), F.count_if("kept")).first()
    assert right >= 0.98 * n and kept == n


def test_language_evidence(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.fit(language_id._labelled(docs))
    text = docs.where("lang = 'de' and length(text) > 500").first()["text"]
    rows = [(1, text, None, None, None, None), (2, None, "de-AT", None, None, None), (3, None, None, "fr", "x.fr", "a.x.fr"), (4, None, None, None, None, None), (5, "%%% 123", "xx", "com", None, None), (6, "цзъ" * 80, None, None, None, None), (7, text, "en", "com", "h.com", "a.h.com"), (7, text, "en", "com", "h.com", "a.h.com")]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, domain string, host string")
    got = {r["id"]: r for r in language_id.identify(frame, models, ["id"]).collect()}
    assert [got[i]["language"] for i in (1, 2, 3, 7)] == ["de", "de", "fr", "de"]
    assert all(got[i]["kept"] for i in (1, 2, 3, 7)) and not got[4]["kept"] and got[4]["language"] == "und" and not got[6]["kept"]
    assert got[5]["kept"] and got[5]["language"] == "xx"  # only the declaration says anything
    assert language_id.identify(frame, models, ["id"]).count() == 8
    assert language_id.identify(frame.limit(0), models, ["id"]).count() == 0


def test_language_of_pages(spark):
    """Every page once; nearly all agree with what they declare, and as many when the declaration is taken away."""
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    said = pages.select("page_id", F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z]{2})", 1)).alias("said"))
    models = language_id.fit(language_id._labelled(spark.read.parquet(f"{sf}/documents.parquet")))
    whole = language_id.language_id_pages(spark, sf)
    assert whole.count() == pages.count() == whole.select("page_id").distinct().count()
    bare = pages.withColumns({"html": F.regexp_replace("html", r"(?i)(<html)[^>]*>", "$1>"), "url": F.lit("https://x.example/")})
    for got in (whole, language_id.identify(language_id.pages_evidence(bare), models, ["page_id"])):
        n, right = got.join(said, "page_id").where(F.col("said").isin(*models.languages)).agg(F.count("*"), F.count_if(F.col("language") == F.col("said"))).first()
        assert n > 50 and right >= 0.95 * n


def test_declared_language_without_a_model_is_kept(spark):
    """Three documents of a language that no model knows stay; the same text without a declaration, or an English one, goes by its own."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source")
    english = docs.where("lang = 'en' and length(text) > 500").first()["text"]
    rare = [(10_000 + i, "цзъ фыв прол " * 40 + str(i), "ru", "web") for i in range(3)] + [(10_010, "цзъ фыв прол " * 40, None, "web"), (10_011, english, "ru", "web")]
    every = docs.unionByName(spark.createDataFrame(rare, docs.schema))
    models = language_id.fit(language_id._labelled(every))
    got = {r["doc_id"]: r for r in language_id.identify(language_id.documents_evidence(every), models, ["doc_id", "row_key"]).where("doc_id >= 10000").collect()}
    assert all(got[10_000 + i]["language"] == "ru" and got[10_000 + i]["kept"] for i in range(3)) and "ru" not in models.languages
    assert not got[10_010]["kept"] and got[10_011]["language"] == "en"
    assert len(language_id.fit(language_id._labelled(every), sample=5).languages) == 4


def test_posterior_against_brute_force(spark):
    """Every probability from counts and logarithms written out, with the row's own count left out of its priors."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.fit(language_id._labelled(docs))
    texts = [r["text"][:120] for r in docs.where("length(text) > 200").orderBy("doc_id").limit(60).collect()]
    rng = random.Random(6)
    rows = [(i, rng.choice([t, t, t, None, "12 3"]), rng.choice([None, "en", "de-AT", "ru", "??"]), *rng.choice([(None, None, None), ("de", "x.de", "a.x.de"), ("com", "y.com", "y.com"), ("com", "y.com", "b.y.com")])) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, domain string, host string, language string".replace(", language string", "")).withColumns({c: F.lit("clash") for c in ("language", "n0", "own", "prior", "other")})
    got = {r["id"]: r for r in language_id.identify(frame, models, ["id"]).collect()}
    names = [*models.languages, "other", "und"]
    k = len(names)
    start = [math.log((1 - language_id.UND_PRIOR) / (k - 1))] * (k - 1) + [math.log(language_id.UND_PRIOR)]

    def parts(row):
        _, text, declared, suffix, _, _ = row
        sums, n = models.score([(text or "").encode()])
        known = {"en": "en", "de-AT": "de", "ru": "other"}.get(declared)
        told = [0.0 if known is None else math.log(1 - language_id.DECLARED_WRONG) if x == known else math.log(language_id.DECLARED_WRONG / (k - 1)) for x in names]
        country = {"de": "de"}.get(suffix)
        hint = [0.0 if country is None else math.log(1 - language_id.SUFFIX_WRONG) if x == country else math.log(language_id.SUFFIX_WRONG / (k - 1)) for x in names]
        text_logs = [*sums[0][:-1], sums[0][-1] if known == "other" else language_id.NEVER, sums[0][-1]]
        first = max(range(k), key=lambda i: text_logs[i] + told[i] + start[i])
        return text_logs, told, hint, first if n[0] or known else None

    every = [parts(r) for r in rows]
    place = [tuple(x or "" for x in (r[3], r[4], r[5])) for r in rows]
    for i, row in enumerate(rows):
        text_logs, told, hint, _ = every[i]
        prior = [math.exp(x) for x in start]
        for depth in (0, 1, 2, 3):
            n = [sum(1 for j in range(len(rows)) if j != i and place[j][:depth] == place[i][:depth] and every[j][3] == x) for x in range(k)]
            prior = [(c + language_id.STRENGTH * p) / (sum(n) + language_id.STRENGTH) for c, p in zip(n, prior, strict=True)]
        logs = [a + b + c + math.log(p) for a, b, c, p in zip(text_logs, told, hint, prior, strict=True)]
        best = max(range(k), key=lambda x: logs[x])
        want = 1 / sum(math.exp(x - max(logs)) for x in logs)
        if row[1] in (None, "12 3") and row[2] in (None, "??") and row[3] is None:
            assert got[i]["language"] == "und" and got[i]["probability"] == 0
        else:
            assert got[i]["probability"] == pytest.approx(want, rel=1e-6)
            assert got[i]["language"] == ("ru" if names[best] == "other" else names[best])


def test_host_prior_decides_without_other_evidence(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.fit(language_id._labelled(docs))
    texts = [r["text"] for r in docs.where("lang = 'es' and length(text) > 300").limit(30).collect()]
    rows = [(i, t, None, "com", "h.com", "a.h.com") for i, t in enumerate(texts)] + [(99, None, None, "com", "h.com", "b.h.com")]
    frame = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, domain string, host string")
    assert language_id.identify(frame, models, ["id"]).where("id = 99").first()["language"] == "es"


# --- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns
        after = spark.createDataFrame(after.collect(), docs.schema)
        if name in ("language_id", "line_dedup"):
            assert after.count() == before.count()
        if name == "near_dedup":
            assert 0 < after.count() < before.count() and after.join(before, "doc_id", "left_anti").count() == 0
        if name == "mixing":
            assert after.select("doc_id").distinct().count() == before.count()
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert packed.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_pipeline_takes_nulls_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "the words of this line are many and it is over forty signs long"
    for rows in ([], [(None, None, None, None, None), (1, None, "en", "a", 0), (2, text, None, None, None), (2, text, "en", "a", 3), (3, text, "en", "b", 3)]):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= (1 if rows else 0)


def test_pipeline_keeps_clashing_columns(spark):
    clash = ["text_kept", "n_lines", "gone", "block", "blocks", "epoch", "_gone", "_d", "c0", "bucket", "comp", "n_tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.col("doc_id") for c in clash})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), docs.schema)
    assert docs.where("text_kept <> doc_id or gone <> doc_id or epoch <> doc_id or c0 <> doc_id or _gone <> doc_id").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_sha_of_conversation_probe(spark):
    got = {r["conv_id"]: r for r in chat_format.op4_chat_format(spark, SF).where("conv_id = -7").collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert got["n_turns"] == 2 and got["loss_chars"] == len(text) and got["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_chat_query_reads_the_examples_texts(spark, monkeypatch):
    """What is learnt comes out of each example's own text: another text in the examples is another digest."""
    real = chat_format.expand_prefix_targets
    monkeypatch.setattr(chat_format, "expand_prefix_targets", lambda *a, **k: real(*a, **k).withColumn("text", F.regexp_replace("text", "(?s).", "z")))
    got = {r["conv_id"]: r for r in chat_format.op4_chat_format(spark, SF).where("conv_id = -7").collect()}[-7]
    body = "\\e\\h\\h\\h Assistant: \\l/turn> ok"
    assert got["n_turns"] == 2 and got["loss_chars"] == len(body) and got["loss_sha256"] == hashlib.sha256(b"z" * len(body)).hexdigest()
