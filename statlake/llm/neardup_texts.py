"""Near-duplicate texts by Order MinHash, verified by banded alignment.

A text is the sequence of its shingles of five words; a shingle's second occurrence counts as another
shingle.  Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest shingles and keeps them in the order in
which they stand, so two texts share a sketch where they have the same shingles in the same order.  Texts
with a sketch in common are candidates.  A candidate is verified by aligning both sequences inside the band that
a similarity of 0.8 leaves open: with m shingles matched in order, of n and k, the similarity is m / (n + k - m).

A sketch that many texts share is worked off without listing its pairs.  Every text is first compared with the
most central text of each sketch; what is linked is united over the cluster.  Where texts with a common sketch are then still apart,
all pairs that are apart are looked at in tiles of bounded size, with parity bitmaps: two bitmaps cannot differ in more bits than the
texts differ in shingles, so a pair that differs in more than the band allows is out, and only the others are aligned.
No candidate is dropped otherwise.  Exact copies are one text from the start.

Defined results: a text without a word (null, empty, white space) is a class of its own; a text of fewer than five words is one
shingle; words are cut at white space and compared in lower case; a class is named by its smallest document id, and by null where none has an id; an
empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..plans.lineage import cut_lineage
from .common import free_name, mixed
from .components import components

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKED = 3
PARITY_BYTES = 128
TILE = 2048
BIN_ROWS = 4096
KEPT_WORDS = 150_000
_AT_ONCE = 1 << 20  # hash values looked at together for one text

_seeds = np.random.default_rng(20190606)
_ODD = _seeds.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _seeds.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Hashes of a text's shingles in order, each occurrence of one shingle with a hash of its own."""
    words = (text or "").lower().split()
    hashes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    if not width:
        return hashes
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(width):
            rolled = mixed(rolled + hashes[at:len(rolled) + at])
        order = np.argsort(rolled, kind="stable")
        ranked = rolled[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        occurrence = np.arange(len(ranked)) - np.repeat(first, np.diff(np.r_[first, len(ranked)]))
        labelled = np.empty_like(rolled)
        labelled[order] = mixed(ranked + occurrence.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return labelled


def sketches(labelled: np.ndarray) -> np.ndarray:
    """One hash per hash function: of its smallest shingles, in text order."""
    picked = min(PICKED, len(labelled))
    out = np.arange(SKETCHES, dtype=np.uint64)
    step = max(1, _AT_ONCE // len(labelled))
    with np.errstate(over="ignore"):
        for at in range(0, SKETCHES, step):
            rows = slice(at, at + step)
            values = (labelled ^ _FLIP[rows, None]) * _ODD[rows, None]
            places = (np.argpartition(values, picked - 1, axis=1)[:, :picked] if picked < len(labelled)
                      else np.tile(np.arange(picked), (len(values), 1)))
            places.sort(axis=1)
            for column in places.T:
                out[rows] = mixed(out[rows] * np.uint64(0x9E3779B97F4A7C15) + labelled[column])
    return out


def parity(labelled: np.ndarray) -> bytes:
    """A bitmap: whether an odd number of shingles falls on each bit."""
    bits = np.bincount((labelled >> np.uint64(20)).astype(np.int64) % (8 * PARITY_BYTES), minlength=8 * PARITY_BYTES)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def most_apart(n, k, similarity: float = SIMILARITY):
    """Shingles that texts of n and k shingles may have unmatched, together."""
    return (n + k) * (1 - similarity) / (1 + similarity) + 1e-9


def matched(a: np.ndarray, b: np.ndarray, band: float) -> int:
    """Shingles matched in order, within ``band`` places of the diagonal.

    Each hash stands once in a text, so matches are points, and the longest alignment is the longest run of
    points that rises in both texts.
    """
    _, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(at - to) <= band
    to = to[near][np.argsort(at[near])]
    if (to[1:] > to[:-1]).all():
        return len(to)
    ends: list[int] = []
    for place in to.tolist():
        where = bisect_left(ends, place)
        if where == len(ends):
            ends.append(place)
        else:
            ends[where] = place
    return len(ends)


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    if not len(a) or not len(b):
        return False
    m = matched(a, b, most_apart(len(a), len(b), similarity))
    return m >= similarity * (len(a) + len(b) - m) - 1e-9


# ------------------------------------------------------------------ over the cluster

def _sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row_id, cid, n, parity, sketches`` of every text with a word; ``cid`` tells exact texts apart."""
    kind = docs.schema[key].dataType.simpleString()

    def sketch(batches):
        for batch in batches:
            rows, columns = [], ([], [], [])
            for row, t in enumerate(batch.column(2)):
                labelled = shingles(t.as_py())
                if len(labelled):
                    rows.append(row)
                    for column, value in zip(columns, (len(labelled), parity(labelled), sketches(labelled).view(np.int64))):
                        column.append(value)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.list_(pa.int64()))],
                names=["row_id", "cid", "n", "parity", "sketches"])

    return docs.select(F.col(key).alias("row_id"), F.xxhash64(text).alias("cid"), F.col(text).alias("t")).mapInArrow(
        sketch, f"row_id {kind}, cid long, n long, parity binary, sketches array<long>")


def _within_band(n: np.ndarray, k: np.ndarray, one: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    return np.bitwise_count(one ^ other).sum(-1) <= most_apart(n, k, similarity)


def _words64(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """Those of the ``a, b`` pairs that are similar."""
    bound = classes.select("cid", "n", "parity")
    both = (pairs.join(bound.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("parity").alias("p_a")), "a")
            .join(bound.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("parity").alias("p_b")), "b"))

    def possible(batches):
        for batch in batches:
            frame = batch.to_pandas()
            if len(frame):
                frame = frame[_within_band(frame["n_a"].to_numpy(), frame["n_b"].to_numpy(), _words64(frame["p_a"]),
                                           _words64(frame["p_b"]), similarity)]
            yield pa.RecordBatch.from_pandas(frame[["a", "b"]], preserve_index=False)

    left = cut_lineage(both.select("a", "b", "n_a", "n_b", "p_a", "p_b").mapInArrow(possible, "a long, b long"), "possible")
    wanted = left.select(F.col("a").alias("cid")).unionAll(left.select("b")).distinct().join(classes.select("cid", "least"), "cid")
    # One row stands for all copies of a text: the one with the class's smallest id.
    all_texts = docs.select(F.col(key).alias("row_id"), F.xxhash64(text).alias("cid"), F.col(text).alias("t"))
    texts = cut_lineage(
        all_texts.join(wanted.select(F.col("cid").alias("c"), "least"),
                       (F.col("cid") == F.col("c")) & F.col("row_id").eqNullSafe(F.col("least")))
        .select("cid", "t").dropDuplicates(["cid"]), "texts")
    met = (left.join(texts.select(F.col("cid").alias("b"), F.col("t").alias("t_b")), "b")
           .join(texts.select(F.col("cid").alias("a"), F.col("t").alias("t_a")), "a"))

    def align(batches):
        last, kept = None, None
        for batch in batches:
            links = []
            a, b, text_a, text_b = batch.columns
            for row in range(batch.num_rows):
                if a[row].as_py() != last:
                    last, kept = a[row].as_py(), shingles(text_a[row].as_py())
                if similar(kept, shingles(text_b[row].as_py()), similarity):
                    links.append(row)
            take = pa.array(links, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["u", "v"])

    return met.select("a", "b", "t_a", "t_b").mapInArrow(align, "u long, v long")


def _apart(frame: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Pairs with a common sketch, not united yet, that the bitmaps allow to be similar."""
    found_a, found_b = [], []
    frame = frame.sort_values(["bucket", "first", "second", "n"], ignore_index=True)
    keys = frame[["bucket", "first", "second"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
    cid, component, n, tile = (frame[c].to_numpy() for c in ("cid", "component", "n", "tile"))
    maps = _words64(frame["parity"])
    for begin, end in zip(starts.tolist(), [*starts[1:].tolist(), len(frame)]):
        across = keys[begin, 1] != keys[begin, 2]
        for row in range(begin, end - 1):
            # In order of length: those beyond the longest possible partner are out.
            last = begin + int(np.searchsorted(n[begin:end], n[row] / similarity + 1e-9, "right"))
            others = slice(row + 1, last)
            good = component[others] != component[row]
            if across:
                good &= tile[others] != tile[row]
            at = row + 1 + np.flatnonzero(good)
            at = at[_within_band(n[row], n[at], maps[row], maps[at], similarity)]
            found_a.append(np.minimum(cid[row], cid[at]))
            found_b.append(np.maximum(cid[row], cid[at]))
    if not found_a:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    return pd.DataFrame({"a": np.concatenate(found_a), "b": np.concatenate(found_b)}).drop_duplicates()


def _still_apart(shared: DataFrame, classes: DataFrame, united: DataFrame, similarity: float, tile: int) -> DataFrame:
    """``a, b``: pairs with a common sketch in different components that may be similar."""
    placed = shared.join(united.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    split = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                          F.count(F.lit(1)).alias("size")).where(F.col("low") != F.col("high")).select("bucket", "size"))
    rows = cut_lineage(placed.drop("size").join(split, "bucket"), "apart")
    bins = max(1, -(-rows.count() // BIN_ROWS))
    tiles = F.ceil(F.col("size") / tile).cast("int")
    spread = (rows.join(classes.select("cid", "n", "parity"), "cid").withColumn("tiles", tiles)
              .withColumn("tile", F.pmod(F.xxhash64("cid", "bucket"), F.col("tiles")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .withColumn("first", F.least("tile", "other")).withColumn("second", F.greatest("tile", "other"))
              # Small groups share a task's frame, a tile of a large one has its own.
              .withColumn("bin", F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("bucket"), F.lit(bins)))
                          .otherwise(F.xxhash64("bucket", "first", "second"))))
    return (spread.select("bin", "bucket", "first", "second", "tile", "cid", "component", "n", "parity").groupBy("bin")
            .applyInPandas(lambda frame: _apart(frame, similarity), "a long, b long").distinct())


def classes_of(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
               tile: int = TILE) -> DataFrame:
    """``row_id, cid, component, class_id`` of every row with a word: its id, its exact text, its class, and that class's
    smallest id."""
    rows = cut_lineage(_sketched(docs, key, text), "sketches")
    classes = cut_lineage(rows.groupBy("cid").agg(
        F.min("row_id").alias("least"), F.any_value("n").alias("n"), F.any_value("parity").alias("parity"),
        F.any_value("sketches").alias("sketches")), "texts")
    listed = classes.select("cid", F.explode("sketches").alias("bucket"))
    sizes = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    shared = cut_lineage(listed.join(sizes, "bucket"), "shared")
    # The text that shares its sketches with most others stands in the middle of its group.
    central = shared.groupBy("cid").agg(F.sum("size").alias("weight"))
    middle = cut_lineage(shared.join(central, "cid").groupBy("bucket").agg(
        F.max_by("cid", F.struct("weight", -F.col("cid"))).alias("a")), "middle")
    stars = cut_lineage(shared.select("bucket", F.col("cid").alias("b")).join(middle, "bucket").where(F.col("a") != F.col("b"))
                        .select("a", "b").distinct(), "stars")
    linked = cut_lineage(_verified(stars, classes, docs, key, text, similarity), "linked")
    united = components(linked)
    seen = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = cut_lineage(_still_apart(shared, classes, united, similarity, tile).join(seen, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = cut_lineage(_verified(rest, classes, docs, key, text, similarity), "more")
        united = components(linked.unionByName(more))
    named = classes.select("cid", "least").join(united.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn(
        "component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("least").alias("class_id"))
    names = cut_lineage(named.join(smallest, "component").select("cid", "component", "class_id"), "names")
    return rows.select("row_id", "cid").join(names, "cid")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, kept``, a row for each row of ``docs``."""
    found = classes_of(docs, key, text, similarity).select(F.col("row_id").alias(key), "class_id")
    wordless = docs.where(_wordless(text)).select(key, F.col(key).alias("class_id"))
    return found.unionByName(wordless).withColumn("kept", F.col(key).eqNullSafe(F.col("class_id")))


def _wordless(text: str):
    # What Python's split() takes for white space, so that both paths part the rows alike.
    return ~F.coalesce(F.col(text).rlike(f"[^{_WHITE}]"), F.lit(False))


# White space as Python's str.split has it.
_WHITE = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows that stay, with all their columns: of each class one row with its smallest id, and all texts without a word."""
    own, named = free_name(docs.columns, "own_cid"), classes_of(docs, key, text, similarity)
    # Of copies of one text the first with that id; of different texts with one id in one class the smaller hash.
    one = cut_lineage(named.where(F.col("row_id").eqNullSafe(F.col("class_id"))).groupBy("component", "class_id")
                      .agg(F.min("cid").alias("c")).select(F.col("class_id").alias("i"), "c"), "stay")
    kept = (docs.withColumn(own, F.xxhash64(text)).join(one, (F.col(own) == F.col("c")) & F.col(key).eqNullSafe(F.col("i")))
            .dropDuplicates([key, own]).select(docs.columns))
    return kept.unionByName(docs.where(_wordless(text)))
