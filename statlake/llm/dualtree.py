"""Exact ranked lexical search with two trees: one over the items that ask, one over the documents.

Each item is a vector of term weights, each document a vector of term impacts, a score their inner product.  A node of the
item tree holds, for every term, the greatest weight among its items, a node of the document tree the greatest impact
among its documents; the product of both bounds every score between them.  Walking down both trees at once, a pair of nodes is left out
with all that hangs below it if its bound is under the weakest k-th score of the node's items.  Only pairs of leaves that remain
are scored.  Nothing is approximate: bounds and scores are integers, and equal scores are never left out.

Items are taken in blocks of at most ``BLOCK_ITEMS``; a task reads a block from the shared folder.  Documents stay where they
are: one pass counts the block's terms in whole texts and writes them, then tasks build trees over a few thousand documents at a
time and keep k documents per item.  A pass over one in ``SEED_SHARE`` documents comes first; its k-th scores, which bound the final
ones from below, are where the weakest scores start, so that tasks return few rows.  Spark ranks what the tasks return.

Defined results: a null text has no terms; rows of one item id are one item with the terms of all its texts, a null id is an item too; an
item without terms or without a document of positive score has no rows; documents with a repeated id are ranked row by row, those with a null id
come last among equals; no documents or no items give no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import math
from heapq import heappush, heapreplace
from itertools import count as counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..operators.ranking import with_row_index
from ..plans.lineage import cut_lineage, scratch_path
from .common import new_file, open_file, write_file

TOP = 50
BLOCK_ITEMS = 256
BLOCK_TERMS = 1 << 16  # of the items of a block together, unless one item has more
ITEM_LEAF = 4
DOC_LEAF = 16
SKETCH = 512  # columns that documents' terms are folded into to find alike ones
FANOUT = 4
DOCS_AT_ONCE = 8192
POSTINGS_AT_ONCE = 1 << 20
SEED_SHARE = 64
EXACT = 1 << 53  # sums of integers in doubles are exact below

# Bytes of terms stay, A-Z in lower case; any other byte is a blank.
_BYTES = bytes((b | 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def terms_column(text: str) -> Column:
    return F.regexp_extract_all(F.translate(F.col(text), _CAPITALS, _SMALL), F.lit(_TERM), F.lit(0))


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


# ------------------------------------------------------------------ blocks of items

def item_blocks(items: DataFrame, item: str, text: str, rows: int = BLOCK_ITEMS, terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per block of items: ``uri`` of a file with their ids and terms."""
    folder = scratch_path(items.sparkSession, "items")
    own = (items.select(F.col(item).alias("item"), F.explode(terms_column(text)).alias("term"))
           .groupBy("item").agg(F.collect_set("term").alias("terms")))
    numbered = with_row_index(own, [F.col("item").asc_nulls_first()], "at")

    def write(table: pa.Table) -> pa.Table:
        table = table.select(["item", "terms"])
        sizes = np.array([len(t) for t in table.column("terms").to_pylist()])
        place = np.cumsum(sizes) // terms
        uris = []
        for part in np.unique(place):
            sink = pa.BufferOutputStream()
            own_rows = table.take(pa.array(np.flatnonzero(place == part)))
            with pa.ipc.new_stream(sink, own_rows.schema) as out:
                out.write_table(own_rows)
            uris.append(new_file(folder, ".items"))
            write_file(uris[-1], [sink.getvalue().to_pybytes()])
        return pa.table({"uri": pa.array(uris, pa.string())})

    return numbered.withColumn("block", F.floor(F.col("at") / rows)).groupBy("block").applyInArrow(write, "uri string")


class Block:
    """Items of a file, and the numbers of their terms."""

    def __init__(self, uri: str):
        with open_file(uri) as f:
            table = pa.ipc.open_stream(f.read()).read_all()
        self.items = table.column("item").to_pylist()
        own = [[t.encode() for t in row] for row in table.column("terms").to_pylist()]
        self.number = {term: at for at, term in enumerate(sorted(set().union(*own)))}
        self.terms = [np.array(sorted(map(self.number.__getitem__, row)), np.int64) for row in own]


@functools.lru_cache(maxsize=2)
def block(uri: str) -> Block:
    return Block(uri)


def postings(docs: DataFrame, uri: str, key: str, text: str) -> DataFrame:
    """``doc_id``, ``n`` and how often each of a block's terms occurs, from whole texts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType), T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))])

    def find(batches):
        known = block(uri).number
        for batch in batches:
            lengths, terms, tfs, ends = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                found: dict = {}
                for number in filter(lambda x: x is not None, map(known.get, words)):
                    found[number] = found.get(number, 0) + 1
                lengths.append(len(words))
                terms.extend(found.keys())
                tfs.extend(found.values())
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=schema.names)

    return docs.select(key, text).mapInArrow(find, schema)


# ------------------------------------------------------------------ trees

def halves(vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows near one of two unlike vectors, and as many near the other."""
    one = vectors[rows] @ vectors[rows[0]]
    far = vectors[rows] @ vectors[rows[int(np.argmin(one))]]
    near = vectors[rows] @ vectors[rows[int(np.argmin(far))]]
    split = rows[np.argsort(far - near, kind="stable")]
    return split[:len(split) // 2], split[len(split) // 2:]


class ItemTree:
    """Binary tree over items; items of a node stand next to each other, and every node holds the greatest weights."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, leaf: int = ITEM_LEAF):
        dense = np.zeros((len(terms), len(weights)))
        for row, own in enumerate(terms):
            dense[row, own] = weights[own]
        self.order: list[int] = []
        self.first, self.last, self.children, tops = [], [], [], []

        def grow(rows: np.ndarray) -> int:
            node, first = len(self.first), len(self.order)
            self.first.append(first)
            self.last.append(first + len(rows))
            self.children.append([])
            tops.append(dense[rows].max(0))
            if len(rows) <= leaf:
                self.order.extend(rows.tolist())
                return node
            self.children[node] = [grow(half) for half in halves(dense, rows)]
            return node

        grow(np.arange(len(terms)))
        self.weights = dense[self.order]
        self.tops = np.array(tops)
        self.first, self.last = np.array(self.first), np.array(self.last)
        self.most = float(self.weights.sum(1).max()) * 1e6  # no impact exceeds 1e9 / 1000

    def weakest(self, floors: np.ndarray) -> np.ndarray:
        return np.array([floors[a:b].min() for a, b in zip(self.first, self.last)])


class DocNode:
    __slots__ = ("terms", "tops", "children", "rows", "matrix")

    def __init__(self, terms, tops, children=(), rows=None, matrix=None):
        self.terms, self.tops, self.children, self.rows, self.matrix = terms, tops, children, rows, matrix


def doc_tree(rows: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray, leaf: int = DOC_LEAF) -> DocNode | None:
    """Tree over documents given as (row, term, impact), rows ascending; like documents share leaves."""
    if not len(rows):
        return None
    found, first, sizes = np.unique(rows, return_index=True, return_counts=True)
    within = np.repeat(np.arange(len(found)), sizes)
    vectors = np.zeros((len(found), SKETCH), np.float32)
    np.add.at(vectors, (within, terms % SKETCH), (values * weights[terms]).astype(np.float32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    order: list[int] = []
    waiting = [np.arange(len(found))]
    while waiting:
        part = waiting.pop()
        if len(part) <= leaf:
            order.extend(part.tolist())
        else:
            waiting.extend(halves(vectors, part))
    order = np.array(order)
    nodes = []
    for at in range(0, len(order), leaf):
        own = order[at:at + leaf]
        places = np.concatenate([np.arange(first[d], first[d] + sizes[d]) for d in own.tolist()])
        held, column = np.unique(terms[places], return_inverse=True)
        matrix = np.zeros((len(own), len(held)))
        matrix[np.repeat(np.arange(len(own)), sizes[own]), column] = values[places]
        nodes.append(DocNode(held, matrix.max(0), rows=found[own], matrix=matrix))
    while len(nodes) > 1:
        parents = []
        for at in range(0, len(nodes), FANOUT):
            own = nodes[at:at + FANOUT]
            held, column = np.unique(np.concatenate([n.terms for n in own]), return_inverse=True)
            tops = np.zeros(len(held))
            np.maximum.at(tops, column, np.concatenate([n.tops for n in own]))
            parents.append(DocNode(held, tops, own))
        nodes = parents
    return nodes[0]


class Search:
    """The best documents of every item of a block, over as many trees as come."""

    def __init__(self, tree: ItemTree, floors: np.ndarray, k: int = TOP):
        self.tree, self.k = tree, k
        self.floors = np.maximum(floors[tree.order], 1).astype(float)  # scores have to be above 0
        self.weakest = tree.weakest(self.floors)
        self.best: list[list] = [[] for _ in tree.order]
        self.pairs = self.left_out = self.scored = 0
        self.ticket = counter()

    def run(self, root: DocNode | None, ids: list) -> None:
        if root is not None:
            self._walk(root, np.zeros(1, np.int64), ids)

    def _bounds(self, node: DocNode, items: np.ndarray) -> np.ndarray:
        return self.tree.tops[np.ix_(items, node.terms)] @ node.tops

    def _remaining(self, node: DocNode, items: np.ndarray) -> np.ndarray:
        kept = items[self._bounds(node, items) >= self.weakest[items]]
        self.pairs += len(items)
        self.left_out += len(items) - len(kept)
        return kept

    def _walk(self, node: DocNode, items: np.ndarray, ids: list) -> None:
        """Documents of a node against items of some nodes of the item tree."""
        items = self._remaining(node, items)
        if not len(items):
            return
        below = self._children(items)
        if node.matrix is None:
            order = sorted(node.children, key=lambda child: -float(self._bounds(child, items).max()))
            for child in order:
                self._walk(child, below, ids)
            return
        while any(self.tree.children[i] for i in below.tolist()):
            below = self._remaining(node, below)
            if not len(below):
                return
            below = self._children(below)
        below = self._remaining(node, below)
        if len(below):
            rows = np.concatenate([np.arange(self.tree.first[i], self.tree.last[i]) for i in below.tolist()])
            self._score(node, rows, ids)

    def _children(self, items: np.ndarray) -> np.ndarray:
        return np.array([c for i in items.tolist() for c in (self.tree.children[i] or [i])], np.int64)

    def _score(self, node: DocNode, items: np.ndarray, ids: list) -> None:
        scores = self.tree.weights[np.ix_(items, node.terms)] @ node.matrix.T
        self.scored += scores.size
        hits = np.argwhere(scores >= self.floors[items][:, None])
        for at, doc in hits.tolist():
            item, row = int(items[at]), int(node.rows[doc])
            key = ids[row]
            entry = (int(scores[at, doc]), -math.inf if key is None else -key, next(self.ticket), key)
            held = self.best[item]
            if len(held) < self.k:
                heappush(held, entry)
            elif entry[:2] > held[0][:2]:
                heapreplace(held, entry)
            if len(held) == self.k:
                self.floors[item] = max(self.floors[item], held[0][0])
        if len(hits):
            self.weakest = self.tree.weakest(self.floors)


@functools.lru_cache(maxsize=2)
def _item_tree(uri: str, weights: bytes) -> ItemTree:
    return ItemTree(block(uri).terms, np.frombuffer(weights, np.int64).astype(float))


def best_of_tasks(found: DataFrame, uri: str, weights: np.ndarray, documents: int, length: int, floors: np.ndarray, k: int) -> DataFrame:
    """Every task's best documents for every item: ``item`` (its place in the block), ``doc_id, score``."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", found.schema["doc_id"].dataType),
                           T.StructField("score", T.LongType())])
    packed = weights.astype(np.int64).tobytes()

    def search(batches):
        tree = _item_tree(uri, packed)
        if tree.most >= EXACT:
            raise OverflowError("an item has too many terms for exact sums")
        state = Search(tree, floors, k)
        held, docs, size, key_type = [], 0, 0, None

        def settle():
            lists = pa.concat_arrays([b.column(2) for b in held])
            rows = lists.value_parent_indices().to_numpy().astype(np.int64)
            terms = lists.flatten().to_numpy().astype(np.int64)
            tf = pa.concat_arrays([b.column(3) for b in held]).flatten().to_numpy()
            n = np.concatenate([b.column(1).to_numpy() for b in held])
            m = 100 - 50 + 50 * n * documents // max(length, 1)
            ids = [key for b in held for key in b.column(0).to_pylist()]
            state.run(doc_tree(rows, terms, impacts(tf, m[rows]).astype(float), weights.astype(float)), ids)

        for batch in batches:
            key_type = batch.column(0).type
            held.append(batch)
            docs, size = docs + batch.num_rows, size + len(batch.column(2).flatten())
            if docs >= DOCS_AT_ONCE or size >= POSTINGS_AT_ONCE:
                settle()
                held, docs, size = [], 0, 0
        if held:
            settle()
        rows = [(tree.order[at], key, score) for at, own in enumerate(state.best) for score, _, _, key in own]
        if rows:
            items, keys, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(keys, key_type), pa.array(scores, pa.int64())],
                                             names=schema.names)

    return found.mapInArrow(search, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         k: int = TOP, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Every item's k best documents: item id, ``rank, doc_id, score``."""
    spark = docs.sparkSession
    out = T.StructType([T.StructField(item, items.schema[item].dataType), T.StructField("rank", T.IntegerType()),
                        T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.LongType())])
    results = []
    # One address per block of items; the documents are read once for each.
    for row in cut_lineage(item_blocks(items, item, item_text, block_items), "blocks").toLocalIterator():
        uri = row["uri"]
        found = cut_lineage(postings(docs, uri, key, text), "postings")
        counts = found.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        documents, length = counts[0] or 0, counts[1] or 0
        names = block(uri)
        weights = np.zeros(len(names.number), np.int64)
        # One number per term of the block, and below one per item of it.
        for df in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
            weights[df["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df["df"] + 1)))
        told = found.where(F.size("terms") > 0)
        floors = np.zeros(len(names.items), np.int64)
        seeds = best_of_tasks(told.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0), uri, weights, documents, length, floors, k)
        for seed in _ranked(seeds, k).where(F.col("rank") == k).select("item", "score").collect():
            floors[seed["item"]] = seed["score"]
        best = _ranked(best_of_tasks(told, uri, weights, documents, length, floors, k), k)
        ids = spark.createDataFrame(list(enumerate(names.items)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", out[item].dataType)]))
        results.append(best.join(F.broadcast(ids), "item").select(F.col("id").alias(item), "rank", F.col("doc_id").alias(key), "score"))
    if not results:
        return spark.createDataFrame([], out)
    return functools.reduce(DataFrame.unionByName, results)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
occurrences AS (SELECT r, unnest(terms) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM occurrences GROUP BY r, term),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
scores AS (SELECT item_id, tf.r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(d.terms) * n_docs) // n_terms))))::BIGINT AS score
           FROM q JOIN tf USING (term) JOIN w USING (term) JOIN d ON d.r = tf.r, totals GROUP BY item_id, tf.r),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scores JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""
