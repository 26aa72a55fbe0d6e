"""Packing documents into sequences: first-fit decreasing with a tournament tree of bins.

``token_pieces`` encodes documents and cuts them into pieces of at most one sequence;
``pack`` deals the pieces into random groups of bounded size and packs each group on its own,
so no task ever holds more than one group.  A piece goes into the first bin that still has room;
a tournament tree over the bins' free room finds that bin in logarithmic time.

Defined results: a null text counts as empty (its end id alone is packed); rows with the same
document id are packed separately; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..plans.lineage import cut_lineage
from .common import texts_of
from .tokens import KEPT_WORDS, word_bpe

CAPACITY = 4096
# Pieces of a group: some hundred sequences, of which only the last few can stay part-filled.
GROUP_ROWS = 2048
TEXTS_AT_ONCE = 1 << 20  # characters encoded together

PIECE = [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
         T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())]


def batches_of(texts: list[str], most: int = TEXTS_AT_ONCE):
    """Index ranges of texts with about ``most`` characters together."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def encoded(texts: list[str], path: str, end_id: int, kept: int = KEPT_WORDS):
    """``(index, ids with the end id)`` of each text, as little-endian unsigned 32-bit integers."""
    encoder = word_bpe(path, kept)
    for first, last in batches_of(texts):
        # A very long text alone is encoded part by part.
        ids, counts = encoder.encode_long(texts[first], TEXTS_AT_ONCE) if last == first + 1 else encoder.encode(texts[first:last])
        ids = ids.astype("<u4")
        ends = np.cumsum(counts)
        for i, (end, count) in enumerate(zip(ends, counts)):
            yield first + i, np.append(ids[end - count:end], np.uint32(end_id))


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id",
                 text: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens and, if asked for, ids."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *PIECE]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def cut(batches):
        for batch in batches:
            keys, texts = batch.column(0), texts_of(batch.column(1))
            rows, columns, kept = [], [], []
            for i, ids in encoded(texts, path, end_id):
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append(i)
                    columns.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                    if keep_ids:
                        kept.append(piece.astype(np.int32))
                if len(rows) >= 4096:
                    yield _batch(keys, rows, columns, kept, schema, keep_ids)
                    rows, columns, kept = [], [], []
            if rows:
                yield _batch(keys, rows, columns, kept, schema, keep_ids)

    return docs.select(key, text).mapInArrow(cut, schema)


def _batch(keys, rows, columns, kept, schema, keep_ids):
    arrays = [keys.take(pa.array(rows)), *(pa.array(c, pa.int64()) for c in zip(*columns))]
    if keep_ids:
        arrays.append(pa.array(kept, pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size, largest first, each into the first bin with room."""
    order = np.argsort(-sizes, kind="stable")
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)  # room[1] is the winner; the bins are the leaves
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in order.tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, length: str = "length",
         seed: int = 17) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    Pieces are written once with a random number each; the number of groups follows from the
    count, so groups stay near ``group_rows`` pieces whatever the input's size or its keys.
    """
    written = cut_lineage(pieces.withColumn("__draw", F.rand(seed)), "pieces")
    groups = max(1, -(-written.count() // group_rows))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = first_fit(frame[length].to_numpy(np.int64), capacity)
        group = int(frame["__group"].iloc[0])
        return frame.assign(sequence_id=(group << 32) + bins, offset=offsets)[schema.names]

    return (written.withColumn("__group", F.floor(F.col("__draw") * groups)).drop("__draw")
            .groupBy("__group").applyInPandas(fit, schema))
