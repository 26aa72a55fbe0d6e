"""Exact top-k by inner product from a bit-sliced index.

Every component x becomes floor(64 x).  An index block holds up to ``BLOCK_ROWS`` rows; for each
attribute and each binary digit it keeps one bitmap over these rows (a slice), after the attribute's smallest
value in the block is taken off.  A query adds, with bitmap arithmetic alone, the slices of all
attributes, each at the digits of the query's own value (for a negative value the slices'
complements), by carry-save adders.  What comes out are the slices of all scores at once.
The best rows are then picked from the most significant slice downward; the rows
that still tie on the last slice are the boundary, of which the smallest ids are taken.

Blocks of queries meet blocks of the index; each pair gives at most k rows a query, and the best of
these are ranked by Spark.  Every row is in the index and nothing is approximate.

Defined results: rows with a null id, a null vector, or null or non-finite components take no part; vectors are compared with vectors
of their own length; a query does not meet rows with its own id; a repeated id is a candidate row by row, while equal query rows
are one query; components beyond +-2^31/64 are an error; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import with_row_index
from ..plans.lineage import cut_lineage, scratch_path
from .common import mapped, new_file, write_file

SCALE = 64
BLOCK_ROWS = 1 << 16
BLOCK_QUERIES = 64
MOST_TASKS = 10_000  # each takes several pairs of blocks beyond that


def usable(id_: str, vector: str) -> Column:
    """Rows that take part: an id, and a vector of finite components only."""
    return F.coalesce(F.col(id_).isNotNull() & (F.size(vector) > 0)
                      & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def quantised(vector: str) -> Column:
    """floor(64 x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Smallest value of each attribute, and the slices (attribute, digit, words of 64 rows) of what exceeds it."""
    low = values.min(0)
    over = (values - low).T
    digits = max(1, int(over.max()).bit_length())
    words = -(-values.shape[0] // 64)
    out = np.zeros((values.shape[1], digits, words), np.uint64)
    for digit in range(digits):
        packed = np.packbits((over >> digit & 1).astype(np.uint8), axis=1, bitorder="little")
        padded = np.zeros((values.shape[1], words * 8), np.uint8)
        padded[:, :packed.shape[1]] = packed
        out[:, digit] = padded.view(np.uint64)
    return low, out, digits


def bitmap(mask: np.ndarray) -> np.ndarray:
    packed = np.packbits(mask, bitorder="little")
    padded = np.zeros(-(-len(mask) // 64) * 8, np.uint8)
    padded[:len(packed)] = packed
    return padded.view(np.uint64)


def rows_of(bits: np.ndarray, count: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little")[:count])


def summed(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of a sum, lowest first, from any number of slices at each digit; three of one digit become
    one of it and one of the next until a single slice is left."""
    out, digit = [], 0
    while digit < len(columns):
        waiting = columns[digit]
        if digit + 1 == len(columns) and len(waiting) > 1:
            columns.append([])
        while len(waiting) > 2:
            left = []
            for a, b, c in zip(waiting[0::3], waiting[1::3], waiting[2::3]):
                either = a ^ b
                left.append(either ^ c)
                columns[digit + 1].append(a & b | either & c)
            waiting = left + waiting[len(waiting) - len(waiting) % 3:]
        if len(waiting) == 2:
            columns[digit + 1].append(waiting[0] & waiting[1])
            waiting = [waiting[0] ^ waiting[1]]
        out.append(waiting[0] if waiting else None)
        columns[digit] = []
        digit += 1
    return out


def score_slices(query: np.ndarray, low: np.ndarray, slices: np.ndarray, digits: int) -> tuple[list[np.ndarray], int]:
    """Slices of all scores of a block, less a constant; and that constant."""
    columns: list[list[np.ndarray]] = [[] for _ in range(digits + int(np.abs(query).max()).bit_length() + 1)]
    constant = 0
    for attribute, value in enumerate(query.tolist()):
        constant += value * int(low[attribute])
        size = abs(value)
        if value < 0:  # -v * x = v * (most - x) - v * most
            constant += value * ((1 << digits) - 1)
        for digit in range(digits):
            slice_ = slices[attribute, digit]
            if value < 0:
                slice_ = ~slice_
            for place in range(size.bit_length()):
                if size >> place & 1:
                    columns[digit + place].append(slice_)
    return summed(columns), constant


def best(slices: list, candidates: np.ndarray, count: int, k: int, ids: np.ndarray) -> np.ndarray:
    """Rows with the k highest sums among the candidates, ties to smaller ids."""
    sure = np.zeros_like(candidates)
    missing = k
    if int(np.bitwise_count(candidates).sum()) > k:
        for slice_ in reversed(slices):
            if slice_ is None:
                continue
            high = candidates & slice_
            found = int(np.bitwise_count(high).sum())
            if found > missing:
                candidates = high
            else:
                sure |= high
                missing -= found
                candidates = candidates & ~slice_
            if not missing:
                return rows_of(sure, count)
    boundary = rows_of(candidates, count)
    chosen = boundary[np.lexsort((boundary, ids[boundary]))[:missing]]
    return np.concatenate([rows_of(sure, count), chosen])


def _gathered(size: int):
    """Arrow batches of id and vector, as ``(dim, ids, values)`` of one vector length and at most ``size`` rows."""
    def blocks(batches):
        held: dict[int, list] = {}
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == dim)
                held.setdefault(dim, []).append((ids[at], flat[offsets[at][:, None] + np.arange(dim)]))
                while sum(len(i) for i, _ in held[dim]) >= size:
                    all_ids, all_values = (np.concatenate(x) for x in zip(*held[dim]))
                    yield dim, all_ids[:size], all_values[:size]
                    held[dim] = [(all_ids[size:], all_values[size:])]
        for dim, parts in held.items():
            all_ids, all_values = (np.concatenate(x) for x in zip(*parts))
            if len(all_ids):
                yield dim, all_ids, all_values
    return blocks


HEAD = "<QQQ"  # rows, attributes, digits
HEAD_BYTES = struct.calcsize(HEAD)


def write_index(rows: DataFrame, folder: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write the index of ``id, v`` rows; one row per block: ``uri``, ``dim``."""
    def build(batches):
        for dim, ids, values in _gathered(block_rows)(batches):
            if (values >= 1 << 31).any() or (values <= -(1 << 31)).any():
                raise ArithmeticError("a component is too large for the index")
            low, slices, digits = slices_of(values)
            uri = new_file(folder, ".slices")
            write_file(uri, [struct.pack(HEAD, len(ids), dim, digits), ids.tobytes(), low.tobytes(), slices.tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([dim], pa.int32())], names=["uri", "dim"])

    return cut_lineage(rows.mapInArrow(build, "uri string, dim int"), "index")


def read_block(uri: str):
    """``ids, low, slices, digits`` of a block, as views of the mapped file."""
    data = mapped(uri)
    rows, dim, digits = struct.unpack(HEAD, data[:HEAD_BYTES])
    ids = np.frombuffer(data, np.int64, rows, HEAD_BYTES)
    low = np.frombuffer(data, np.int64, dim, HEAD_BYTES + 8 * rows)
    slices = np.frombuffer(data, np.uint64, -1, HEAD_BYTES + 8 * (rows + dim)).reshape(dim, digits, -1)
    return ids, low, slices, digits


def best_of_block(query_id: int, query: np.ndarray, block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's k best rows for a query."""
    ids, low, slices, digits = block
    sums, constant = score_slices(query, low, slices, digits)
    chosen = best(sums, bitmap(ids != query_id), len(ids), k, ids)
    scores = np.full(len(chosen), constant, np.int64)
    for digit, slice_ in enumerate(sums):
        if slice_ is not None:
            scores += (slice_[chosen >> 6] >> (chosen & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << digit
    return ids[chosen], scores


def top_k(df: DataFrame, queries: Column, k: int = 20, id_: str = "vec_id", vector: str = "embedding",
          block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the k best rows for every row that ``queries`` marks."""
    columns = [F.col(id_).cast("long").alias("id"), quantised(vector).alias("v")]
    rows = df.where(usable(id_, vector)).select(*columns)
    asked = df.where(usable(id_, vector) & queries).select(*columns).distinct()
    # Round robin makes blocks even whatever the ids are.
    index = write_index(rows.repartition(max(1, -(-rows.count() // block_rows))),
                        scratch_path(df.sparkSession, "bit-slices"), block_rows)

    def collect(batches):
        for dim, ids, values in _gathered(block_queries)(batches):
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                              pa.array([values.tobytes()], pa.binary())], names=["query_dim", "ids", "values"])

    groups = with_row_index(asked.mapInArrow(collect, "query_dim int, ids binary, values binary"), ["ids", "query_dim"], "group")
    groups = cut_lineage(groups, "queries")
    n_groups, n_blocks = groups.count(), index.count()
    # Only references to blocks are multiplied; a block of queries is some ten kilobytes.
    pairs = (index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))) if n_groups
             else index.withColumn("group", F.lit(0)))
    pairs = pairs.join(groups, "group").where(F.col("dim") == F.col("query_dim"))

    def answer(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row["uri"])
                ids = np.frombuffer(row["ids"], np.int64)
                vectors = np.frombuffer(row["values"], np.int64).reshape(len(ids), -1)
                for at, (query_id, query) in enumerate(zip(ids.tolist(), vectors)):
                    found, scores = best_of_block(query_id, query, block, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["group"]] * len(found), pa.int64()), pa.array([at] * len(found), pa.int32()),
                         pa.array([query_id] * len(found), pa.int64()), pa.array(found), pa.array(scores)],
                        names=["group", "at", "query_id", "vec_id", "score"])

    answers = (pairs.select("uri", "group", "ids", "values").repartition(max(1, min(n_groups * n_blocks, MOST_TASKS)), "uri", "group")
               .mapInArrow(answer, "group long, at int, query_id long, vec_id long, score long"))
    order = Window.partitionBy("group", "at").orderBy(F.desc("score"), "vec_id")
    return (answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = f"""
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
