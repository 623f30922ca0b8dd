"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from waymark.llm import lexical_search as ls

SCHEMA = "doc_id long, text string, rank int, score string"
ITEMS = "item_id long, text string, doc_id long"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def own_terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return TERM.findall(lower)


def plain(docs, items, keep=50):
    counted = [(i, Counter(own_terms(t))) for i, t, *_ in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text, *_ in items:
        scores = []
        for doc, c, n in counted:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(own_terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        ranked = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:keep]
        out += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(ranked)]
    return sorted(out, key=str)


def rows(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=str)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(13)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本", "x9", "THE", "the"]

    def text(n):
        return rng.choice([" ", ", ", "\n"]).join(rng.choice(words[: rng.choice([8, 65])]) for _ in range(n))

    docs = [(i, text(rng.randint(1, 60)), -1, "x") for i in range(300)]
    docs += [(300, None, 0, ""), (301, "", 0, ""), (302, "?!", 0, ""), (303, "the " * 30_000, 0, ""), (None, "w1 w2", 0, "")]
    docs += [docs[5]] * 3 + [(400 + i, docs[7][1], 0, "") for i in range(90)]
    items = [(i, text(rng.randint(1, 12)), 7) for i in range(25)]
    items += [(90, None, 0), (91, "nowhere", 0), (None, "w1 w3", 0), (3, "w5 W5 x9", 0), (92, docs[7][1], 0)]
    return docs, items


def test_ranks_equal_plain_scores(spark, tables):
    docs, items = tables
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    asked = spark.createDataFrame(items, ITEMS)
    want = plain(docs, items)
    assert rows(ls.search(frame, asked)) == want
    assert rows(ls.search(frame, asked, block_docs=7, block_terms=20)) == want
    assert rows(ls.search(frame, asked, keep=3)) == plain(docs, items, keep=3)


def test_treap_finds_what_a_table_finds():
    rng = np.random.default_rng(1)
    for n_rows, n_columns in ((1, 1), (5, 40), (40, 5), (33, 64)):
        grid = rng.integers(0, 30, (n_rows, n_columns)) * (rng.random((n_rows, n_columns)) < 0.3)
        r, c = np.nonzero(grid >= 0)
        bits = (max(n_rows, n_columns, 2) - 1).bit_length()
        treap = ls.K2Treap(r, c, grid[r, c].astype(np.int64), bits)
        for _ in range(20):
            asked = np.sort(rng.choice(n_rows, rng.integers(1, n_rows + 1), replace=False))
            kept = []
            treap.search(asked, kept, list(range(n_columns)), keep=6, batch=3)
            sums = grid[asked].sum(axis=0)
            want = sorted((-s, c) for c, s in enumerate(sums.tolist()) if s > 0)[:6]
            assert sorted((-s, d) for s, _, d in kept) == want


def test_treap_leaves_ranges_that_cannot_win(monkeypatch):
    columns = np.arange(1 << 12)
    values = np.where(columns < 64, 1000 + columns, 1).astype(np.int64)
    treap = ls.K2Treap(np.zeros_like(columns), columns, values, 12)
    looked, below = [], ls.K2Treap.below
    monkeypatch.setattr(ls.K2Treap, "below", lambda self, n, q: looked.append(len(n)) or below(self, n, q))
    kept = []
    treap.search(np.array([0]), kept, columns.tolist(), batch=8)
    assert min(kept)[0] == 1014 and sum(looked) < 400


@pytest.mark.parametrize("docs, items", [([], [(1, "a", 0)]), ([(1, "a", 0, "")], []), ([(1, None, 0, "")], [(1, None, 0)])])
def test_empty_tables(spark, docs, items):
    frame = ls.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS))
    assert frame.columns == ["item_id", "rank", "doc_id", "score"] and frame.collect() == []
