"""Filter audit, lexical search and token counts against brute force and the library, with every edge case."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dugout.llm import filter_audit as FA
from dugout.llm import lexical_search as LS
from dugout.llm import token_counts as TC
from dugout.llm.common import Scratch

CLASH = ("row", "n", "term", "words", "part", "digest", "good", "toxic", "E", "base")


def docs(spark, rows, more="source string"):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, *("clash" for _ in CLASH)) for r in rows], f"doc_id long, text string, {more}, " + ", ".join(f"`{c}` string" for c in CLASH))


# --- filter audit --------------------------------------------------------------------------------------------------


def fails(rows):
    """Brute force: the set of failed filters of each row."""
    out = []
    for i, t, _ in rows:
        t, found = t or "", ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        found += "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t)) + "D" * any(c in t for c in "#$%&*|")
        found += "E" * any(i is not None and j is not None and j < i and (u or "") == t for j, u, _ in rows)
        out.append(found)
    return out


def audit_brute(rows, labels):
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    failed, out = fails(rows), []
    for part in {s or "" for *_, s in rows}:
        own = [(i, f) for (i, _, s), f in zip(rows, failed, strict=True) if (s or "") == part]
        shares, lines = Counter(), []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shares[x] += len(gone)
                lines.append((part, order, step, len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == x for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*line, shares[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


WORDY = " ".join(f"w{i}" for i in range(200))
AUDIT = [
    (1, None, "a"), (2, "", "a"), (3, WORDY, "a"), (4, WORDY, "b"), (4, WORDY, "b"), (3, WORDY, None), (None, WORDY, "a"), (None, None, ""), (5, "x " * 300, "a"), (6, "ABC " * 300, "b"), (7, "é" * 98 + "AB", "b"), (8, "é" * 97 + "ABC", "b"),
    (9, WORDY + " 100%", "a"), (10, WORDY + "\x0bZ\x1c", "a"), (2, "", "a"), (11, "w " * 100 + WORDY[:-5], "b"), (12, "Long $ " * 40000, "a"), (13, WORDY + " ", "a"),
]
LABELS = [(1, 1, 0), (3, 1, 1), (4, 0, 1), (4, 1, 0), (9, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, None)]


def audited(spark, tmp_path, rows, labels):
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = FA.op11_filter_audit(spark, str(tmp_path))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(map(tuple, got.collect()))


def test_audit(spark, tmp_path):
    rng = random.Random(5)
    made = [(100 + i, rng.choice([WORDY, "x y z", "X " * 250, f"{WORDY} {i % 3}", "#"]), rng.choice(["a", "b", "c", None])) for i in range(80)]
    assert audited(spark, tmp_path, AUDIT + made, LABELS) == audit_brute(AUDIT + made, LABELS)


def test_audit_of_empty_tables(spark, tmp_path):
    assert audited(spark, tmp_path, [], []) == []


def test_audit_without_labels(spark, tmp_path):
    assert audited(spark, tmp_path, AUDIT, []) == audit_brute(AUDIT, [])


def test_shapley_adds_up(spark, tmp_path):
    """Each order's removals are what the filters remove together, so the shares of five filters are 120 times that."""
    got = audited(spark, tmp_path, AUDIT, LABELS)
    for part in ("", "a", "b"):
        first = {r[1][0]: r[9] for r in got if r[0] == part and r[2] == 1}
        total, kept = sum(1 for *_, s in AUDIT if (s or "") == part), {r[3] for r in got if r[0] == part and r[2] == 5}
        assert len(kept) == 1 and sum(first.values()) == 120 * (total - kept.pop())


def test_first_rows_are_cut_before_they_move(spark):
    rows = FA.labelled(FA.judged(docs(spark, AUDIT)), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    plan = FA.firsts(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# --- lexical search ------------------------------------------------------------------------------------------------


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def search_brute(rows, items, top=10):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counted = [(i, k, Counter(term.findall(lower(t or "")))) for k, (i, t, _) in enumerate(rows)]
    counted = [x for x in counted if x[2]]
    n, total = len(counted), sum(c.total() for *_, c in counted)
    df = Counter(t for *_, c in counted for t in c)
    out, asked = [], {}
    for item, text in items:
        asked.setdefault(item, set()).update(term.findall(lower(text or "")))
    for item, ts in asked.items():
        scores = []
        for i, k, c in counted:
            m = 100 - 90 + (90 * c.total() * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, k, i))
        out += [(item, r, i, -s) for r, (s, *_, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "the Cat sat"), (2, None), (3, ""), (4, "zzz none"), (5, "ÉTÉ été 12ab"), (5, "the the cat"), (None, "dog"), (6, "a b c d e f g h")]
TEXTS = [(1, "The cat, the CAT!", "s"), (2, None, "s"), (3, "", "s"), (4, "...", "s"), (5, "été ÉTÉ 12ab_x", "s"), (None, "the dog", "s"), (1, "The cat, the CAT!", "s"), (7, "dog\x00cat\x7fthe", "s"), (8, "cat " * 30000, "s"), (9, "a b a b", "s")]


def searched(spark, rows, items):
    got = LS.search(Scratch(spark, "t"), docs(spark, rows).select("doc_id", "text"), spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def test_search(spark):
    rng = random.Random(2)
    made = [(20 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))), "s") for i in range(60)]
    assert searched(spark, TEXTS + made, ITEMS) == search_brute(TEXTS + made, ITEMS)


def test_items_in_blocks(spark, monkeypatch):
    """Many items are taken block by block, and very many asked terms post all."""
    monkeypatch.setattr(LS, "ITEM_TERMS", 3)
    monkeypatch.setattr(LS.blocks, "__defaults__", (3,))
    assert searched(spark, TEXTS, ITEMS) == search_brute(TEXTS, ITEMS)


def test_search_of_empty_tables(spark):
    assert searched(spark, [], ITEMS) == [] and searched(spark, TEXTS, []) == [] and searched(spark, [(1, None, "s")], ITEMS) == []


def test_equal_scores_go_by_id(spark):
    rows = [(i, "same words", "s") for i in (5, 3, None, 9, 3, *range(20, 40))] + [(100 + i, "other", "s") for i in range(40)]
    got = searched(spark, rows, [(1, "words")])
    assert got == search_brute(rows, [(1, "words")]) and {r[1]: r[2] for r in got} == dict(enumerate([3, 3, 5, 9, 20, 21, 22, 23, 24, 25], 1))


def test_matches_are_summed_where_they_are_made(spark):
    """With few item terms there is no exchange between the postings' files and the sums."""
    scratch = Scratch(spark, "t")
    asked = scratch.save(LS.item_terms(spark.createDataFrame(ITEMS, "item_id long, text string")), "asked")
    posted = LS.write_postings(scratch, docs(spark, TEXTS).select("doc_id", "text"), asked.select("term").distinct(), 100)
    plan = LS.ranked(posted, scratch.save(asked.join(LS.weights(posted, 9), "term"), "w"), 9, 100)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("HashAggregate") :]
    assert "Exchange hashpartitioning" not in below and "BroadcastExchange" in below


# --- token counts --------------------------------------------------------------------------------------------------

PATH = public_tokenizers.path(TC.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


TOKENS = [
    None, "", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext|>  ", "a" * 5000, "é" * 3000, "࢏ x՘", "漢字かな交じり文 " * 50, "I'll 'LL don't", " \n\t  　 x\x85\x1c", "1" * 999, "🙂👩‍👩‍👧" * 30, "ab" * 20000,
    "word " * 1024, "word " * 1023 + "x", " ".join(f"key{i:x}" for i in range(9000)), "<|endoftext|", "﻿�\U0010ffff",
]


def test_token_counts(spark, library):
    rng = random.Random(1)
    signs = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x80, 0x2FFF), rng.randrange(0x10000, 0x1FFFF), 32, 10, 39]))
    texts = TOKENS + ["".join(signs() for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "x y", "s"), (1, "again", "s")]
    got = TC.count_tokens(docs(spark, rows).select("doc_id", "text"), PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_token_counts_of_an_empty_table(spark):
    assert TC.count_tokens(docs(spark, []), PATH).collect() == []


def test_every_code_point(library):
    """Also those whose class the two pattern engines disagree on."""
    count = TC.counter(TC.vocabulary(PATH))
    texts = ["".join(f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)} x" for c in range(first, first + 64)) for first in [*range(0, 0xD800, 64), *range(0xE000, 0x110000, 64 * 7)]]
    assert [count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_strings_are_proven(library):
    """A string is whole if and only if the merges make one token of it; both ways of merging agree."""
    known = TC.vocabulary(PATH)
    some = random.Random(4).sample(sorted(known.whole), 400)
    assert all(len(library.model.tokenize("".join({v: k for k, v in TC.byte_signs().items()}[b] for b in w.encode()))) == 1 for w in some)
    words = [" ".join(some[i : i + 9]).encode() for i in range(0, 400, 9)]
    assert [TC.merged(w[: TC.SHORT], known.ranks, known.made) for w in words] == [TC._merged_long(list(w[: TC.SHORT]), known.ranks, known.made) for w in words]
