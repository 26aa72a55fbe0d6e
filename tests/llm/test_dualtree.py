"""Dual-tree search: against plain scoring of all documents, and against SQL."""

import math
import random
import re

import numpy as np
import pytest

from llm_rows import ROWS
from statlake.llm import dualtree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k):
    own = [(key, words(text)) for key, text in docs]
    total, length = sum(bool(w) for _, w in own), sum(len(w) for _, w in own)
    df = {}
    for _, w in own:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for key, w in own:
            m = 100 - 50 + 50 * len(w) * total // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m))
                        for t in terms if t in w)
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, at, key, -score) for at, (score, _, _, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def random_rows(seed, documents, items):
    draw = random.Random(seed)
    word = lambda: "Ab" + "cdefghij"[min(int(draw.expovariate(.5)), 7)] * draw.choice([1, 1, 2, 3]) + draw.choice(["", "é", "7"])
    text = lambda most: draw.choice([" ", ", ", "\x7f", "\n"]).join(word() for _ in range(draw.randrange(most)))
    docs = [(i, text(30)) for i in range(documents)]
    docs += docs[:7] + [(None, docs[3][1]), (None, None), (9_000, ""), (9_001, None), (9_002, "only " * 500), (9_003, "É é ÉÉ a_b")]
    asked = [(i, text(12)) for i in range(items)] + [(0, text(5)), (None, "abc ABD"), (900, None), (901, ""), (902, "nowhere to be found"), (903, "É a b")]
    return docs, asked


@pytest.mark.parametrize("seed, documents, items, block, k", [(1, 4, 3, 256, 50), (2, 40, 9, 256, 50), (3, 400, 30, 7, 5), (4, 300, 60, 256, 1)])
def test_against_plain_scoring(spark, monkeypatch, seed, documents, items, block, k):
    docs, asked = random_rows(seed, documents, items)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS item", "2 AS n").repartition(4)
    queries = spark.createDataFrame(asked, "item_id long, text string").selectExpr("*", "'y' AS term", "3 AS at")
    got = dualtree.rank(df, queries, k=k, block_items=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, asked, k)


def test_nothing_to_search_or_to_ask(spark, documents):
    asked = spark.createDataFrame([(1, "cat mat")], "item_id long, text string")
    assert dualtree.rank(documents([]), asked).count() == 0
    assert dualtree.rank(documents(ROWS), asked.limit(0)).count() == 0
    assert dualtree.rank(documents(ROWS, True), asked).count() == 1


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(7)
    groups, vocabulary = 8, 400
    items = [np.unique(rng.integers(0, 50, 12) + 50 * (i % groups)) for i in range(64)]
    weights = rng.integers(1, 9000, vocabulary).astype(float)
    rows, terms, values = [], [], []
    for doc in range(3000):
        own = np.unique(rng.integers(0, 50, 20) + 50 * rng.integers(groups))
        rows += [doc] * len(own)
        terms += own.tolist()
        values += rng.integers(1, 900_000, len(own)).tolist()
    rows, terms, values = np.array(rows), np.array(terms), np.array(values, float)
    dense = np.zeros((3000, vocabulary))
    dense[rows, terms] = values
    tree = dualtree.ItemTree(items, weights)
    search = dualtree.Search(tree, np.zeros(64, np.int64), 5)
    for first in range(0, 3000, 1000):
        part = (rows >= first) & (rows < first + 1000)
        search.run(dualtree.doc_tree(rows[part] - first, terms[part], values[part], weights), list(range(first, first + 1000)))
    for at, item in enumerate(tree.order):
        scores = dense[:, items[item]] @ weights[items[item]]
        want = sorted(((-int(s), d) for d, s in enumerate(scores) if s > 0))[:5]
        assert sorted((-s, key) for s, _, _, key in search.best[at]) == want
    assert search.left_out > 0 and search.scored < 64 * 3000 / 2
