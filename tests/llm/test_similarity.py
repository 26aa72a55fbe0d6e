"""Near copies and top-k against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS
from statlake.llm import neardup_texts as texts, neardup_vectors as vectors, topk
from statlake.llm.components import components

VECTOR = "vec_id long, embedding array<float>, label int, score string, id string, node string"


def united(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 199), (None, 3), (199, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {199: 199, 200: 199}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def awkward_vectors(seed=1, n=300, dim=16):
    rng = np.random.default_rng(seed)
    rows, base = [], rng.standard_normal((12, dim))
    for i in range(n):
        v = base[i % 12] + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)]))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, [2 * x for x in rows[3][1]]), (20, rows[20][1])]
    rows += [(600, None), (601, []), (602, [0.0] * dim), (603, [None] + [1.0] * (dim - 1)), (604, [float("nan")] * dim),
             (605, [float("inf")] + [1.0] * (dim - 1)), (606, [1.0, 0.0]), (607, [1.0, 0.0]), (None, rows[0][1]), (None, None)]
    return [(i, v, None if j % 3 else 1, "x", "y", None) for j, (i, v) in enumerate(rows)]


def finite(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("leaf, tile", [(20, 8), (1024, 2048)])
def test_vectors_against_all_pairs(spark, leaf, tile):
    rows = awkward_vectors()
    df = spark.createDataFrame(rows, VECTOR).repartition(3)
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df, leaf=leaf, tile=tile).collect())
    live = [(i, np.array(v, np.float64)) for i, v, *_ in rows if i is not None and finite(v) and any(v)]
    links = [(a, b) for a in range(len(live)) for b in range(a) if len(live[a][1]) == len(live[b][1])
             and live[a][1] @ live[b][1] >= 0.95 * np.linalg.norm(live[a][1]) * np.linalg.norm(live[b][1])]
    degree = Counter(x for pair in links for x in pair)
    roots = united(range(len(live)), links)
    least = {}
    for at, (i, _) in enumerate(live):
        least[roots[at]] = min(i, least.get(roots[at], i))
    want = Counter((i, degree[at], least[roots[at]], i == least[roots[at]]) for at, (i, _) in enumerate(live))
    for i, v, *_ in rows:
        if i is None or not finite(v) or not any(v):
            want[i, 0, i, i is not None] += 1
    assert got == want


def test_a_close_cluster_is_not_split_for_ever(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + rng.standard_normal(16) * 0.01], 1, "", "", "") for i in range(200)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, VECTOR), leaf=20, tile=64).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(199, 0)}


def test_a_node_s_sample_is_drawn_before_it_is_ranked(spark):
    rows = spark.range(40_000).select("id", F.when(F.col("id") < 30_000, 1).when(F.col("id") < 39_900, 2).otherwise(3).cast("long").alias("node"))
    rows = rows.join(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")), "node")
    ranked = {r.node: r["count"] for r in vectors._drawn(rows, 1024).groupBy("node").count().collect()}
    assert 1024 <= ranked[1] < 3000 and 1024 <= ranked[2] < 3000 and ranked[3] == 100
    best = {}
    for r in rows.select("id", "node", F.xxhash64("id", "node").alias("draw")).collect():
        best.setdefault(r.node, []).append((r.draw, r.id))
    want = {(node, i) for node, all_ in best.items() for _, i in sorted(all_)[:1024]}
    assert {(r.node, r.id) for r in vectors._sampled(rows, 1024).select("node", "id").collect()} == want


def test_no_vectors(spark):
    empty = spark.createDataFrame([], VECTOR)
    assert vectors.near_duplicates(empty).count() == 0 and topk.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("block_rows, block_queries, k", [(64, 3, 5), (1 << 16, 64, 20), (1 << 16, 64, 1000)])
def test_top_k_against_all_pairs(spark, block_rows, block_queries, k):
    rows = awkward_vectors(2)
    df = spark.createDataFrame(rows, VECTOR).repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k, block_rows=block_rows, block_queries=block_queries).collect()
    live = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v, *_ in rows if i is not None and finite(v)]
    want = Counter()
    for q, query in {(i, tuple(v)) for i, v in live if i % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in live if i != q and len(v) == len(query))
        want.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k]))
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_bit_slices_add_up():
    rng = np.random.default_rng(5)
    values, query = rng.integers(-900, 900, (333, 7)), rng.integers(-50, 50, 7)
    low, slices, digits = topk.slices_of(values)
    sums, constant = topk.score_slices(query, low, slices, digits)
    got = np.full(333, constant)
    for digit, s in enumerate(sums):
        if s is not None:
            got[topk.rows_of(s, 333)] += 1 << digit
    assert (got == values @ query).all()


def test_components_too_large_for_the_index_are_an_error(spark):
    df = spark.createDataFrame([(20, [1e30, 1.0], 1, "", "", "")], VECTOR)
    with pytest.raises(Exception, match="too large"):
        topk.top_k(df, F.lit(True)).count()


def copies(seed=6):
    """Texts with exact and near copies, chains of copies, a passage in many texts, and awkward rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([8, 60, 300]))]
        rows.append(" ".join(words))
        for share in (0.0, 0.01, 0.03, 0.05, 0.15):
            words = [rng.choice(vocabulary) if rng.random() < share else w for w in words]
            rows.append(" ".join(words) if share else rows[-1])
    rows += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(60)]
    rows += ["Same Words here", "same words  HERE", "two words", "two words", "a b c d", "a b c e", "z " * 400, "z " * 390, "z " * 200]
    return [(i, t, None) for i, t in enumerate(rows)] + [(1000 + (i or 0) if i else None, t, x) for i, t, x in ROWS]


@pytest.mark.parametrize("tile", [16, 2048])
def test_texts_against_all_pairs(spark, documents, tile):
    rows = copies()
    df = documents(rows, True).repartition(4)
    got = Counter((r.row_id, r.class_id) for r in texts.classes_of(df, tile=tile).collect())
    sequences = [texts.shingles(t) for _, t, _ in rows]
    wordy = [i for i in range(len(rows)) if len(sequences[i])]
    links = [(a, b) for a in wordy for b in wordy if a < b and (rows[a][1] == rows[b][1] or texts.similar(sequences[a], sequences[b]))]
    roots = united(wordy, links)
    least = {}
    for i in wordy:
        known = [x for x in (rows[i][0], least.get(roots[i])) if x is not None]
        least[roots[i]] = min(known) if known else None
    assert got == Counter((rows[i][0], least[roots[i]]) for i in wordy)


def test_alignment_is_the_longest_common_subsequence():
    rng = np.random.default_rng(7)
    for _ in range(60):
        a = rng.permutation(60)[:rng.integers(1, 40)].astype(np.uint64)
        b = rng.permutation(60)[:rng.integers(1, 40)].astype(np.uint64)
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert texts.matched(a, b, 1000) == table[-1, -1]
        # The band never hides a similar pair.
        assert texts.similar(a, b) == (table[-1, -1] >= 0.8 * (len(a) + len(b) - table[-1, -1]) - 1e-9)


def test_parity_maps_bound_what_differs():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (rng.integers(0, 1 << 63, rng.integers(1, 3000)).astype(np.uint64) for _ in range(2))
        b[:len(b) // 2] = a[:len(b) // 2] if len(a) >= len(b) // 2 else b[:len(b) // 2]
        bits = np.bitwise_count(np.frombuffer(texts.parity(a), np.uint8) ^ np.frombuffer(texts.parity(b), np.uint8)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_order_matters():
    words = [f"w{i}" for i in range(200)]
    moved = words[100:] + words[:100]
    assert not texts.similar(texts.shingles(" ".join(words)), texts.shingles(" ".join(moved)))


def test_one_of_each_class_stays(spark, documents):
    rows = copies()
    df = documents(rows, True)
    stay = texts.without_copies(df)
    assert stay.columns == df.columns
    classes = {(r.component, r.class_id) for r in texts.classes_of(df).collect()}
    wordless = Counter(i for i, t, _ in rows if not len(texts.shingles(t)))
    assert Counter(r.doc_id for r in stay.collect()) == wordless + Counter(c for _, c in classes)
    assert sum(1 for _ in texts.near_duplicates(df).collect()) == len(rows)


def test_no_texts(spark, documents):
    assert texts.near_duplicates(documents([])).count() == 0 and texts.without_copies(documents([])).count() == 0
