"""Byte-level BPE over whole texts: overlapping chunks, stitched, then encoded; and decoding.

A text of up to ``CHUNK`` characters is encoded where it is.  A longer one is cut into chunks that
overlap; the chunks are pre-tokenised by different tasks, and two neighbours are stitched at the
first pre-token boundary that both found inside their overlap.  From a boundary on, matching
depends only on what follows, so beyond it both agree with the text as a whole.  The stitched pieces
start and end at true boundaries, are encoded by different tasks and joined in order.  Where two
chunks never agree (one pre-token longer than the overlap), the rest of that text is one piece.
Decoding concatenates the raw bytes of the ids.

Defined results: a null text counts as empty (no ids); copies of a row each get their row; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import texts_of

CHUNK = 1 << 15
OVERLAP = 512
# A match is settled only where the chunk goes on for at least this many characters ('re needs three).
SETTLED = 8

# White space as the pattern's \s has it (fixed values: Unicode's White_Space property).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_workers: dict = {}


class ByteBpe:
    """Ranks of a file, a pattern, and the bytes of every id."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes = {number: token for token, number in ranks.items()}
        self.decimal = {number: str(number) for number in ranks.values()}
        explicit = pattern.replace("[^\\s", f"[^{WHITE}").replace("\\S", f"[^{WHITE}]").replace("\\s", f"[{WHITE}]")
        self.pattern = regex.compile(explicit)

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def listed(self, ids: list[int]) -> str:
        return ",".join(map(self.decimal.__getitem__, ids))

    def boundaries(self, text: str) -> np.ndarray:
        return np.fromiter((m.end() for m in self.pattern.finditer(text)), np.int64)


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process and file."""
    if (path, pattern) not in _workers:
        _workers[path, pattern] = ByteBpe(path, pattern)
    return _workers[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP, keep: bool = False) -> DataFrame:
    """key, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; with ``keep`` also ``ids`` (decimal,
    joined by commas) and ``decoded``."""
    rows = docs.select(key, text)
    long = F.length(text) > chunk
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
                          + [T.StructField(n, T.StringType()) for n in ("ids", "decoded")] * keep)

    def whole(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            columns = [[] for _ in schema.names[1:]]
            for t in texts_of(batch.column(1)):
                ids = bpe.encode(t)
                listed, decoded = bpe.listed(ids), bpe.decode(ids)
                values = [len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()]
                for column, value in zip(columns, values + [listed, decoded.decode()] * keep):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns[:1]),
                                              *(pa.array(c, pa.string()) for c in columns[1:])], names=schema.names)

    short = rows.where(~F.coalesce(long, F.lit(False))).mapInArrow(whole, schema)
    return short.unionByName(_in_chunks(rows.where(long), path, pattern, key, text, chunk, overlap, keep)
                             .select(schema.names))


def _in_chunks(rows, path, pattern, key, text, chunk, overlap, keep) -> DataFrame:
    """The long texts, a row per chunk or piece until the end."""
    key_field = T.StructField("key", rows.schema[key].dataType)
    name = [key_field, T.StructField("digest", T.StringType())]
    cut_schema = T.StructType([*name, T.StructField("k", T.LongType()), T.StructField("part", T.StringType())])

    def cut(batches):
        for batch in batches:
            for i, t in enumerate(texts_of(batch.column(1))):
                digest, n = hashlib.md5(t.encode()).hexdigest(), -(-len(t) // chunk)
                for k in range(n):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), pa.array([digest]), pa.array([k], pa.int64()),
                         pa.array([t[k * chunk:(k + 1) * chunk + overlap]])], names=cut_schema.names)

    # Copies of a row have the same chunks: one is kept, with their number.
    chunks = (rows.mapInArrow(cut, cut_schema).groupBy("key", "digest", "k")
              .agg(F.first("part").alias("part"), F.count(F.lit(1)).alias("copies")))
    found_schema = T.StructType([*name, *(T.StructField(n, t) for n, t in (
        ("k", T.LongType()), ("part", T.StringType()), ("copies", T.LongType()),
        ("head", T.ArrayType(T.LongType())), ("tail", T.ArrayType(T.LongType()))))])

    def pre_tokenise(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            heads, tails = [], []
            for part in batch.column(3).to_pylist():
                ends = bpe.boundaries(part)
                ends = ends[ends <= len(part) - SETTLED]
                heads.append(ends[ends <= overlap])
                tails.append(ends[ends >= chunk] - chunk)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=found_schema.names)

    in_order = Window.partitionBy("key", "digest").orderBy("k")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    # Where this chunk takes over, counted from its start; once a join fails, no later one is trusted.
    joins = F.array_min(F.array_intersect(F.lag("tail").over(in_order), "head"))
    stitched = (
        chunks.mapInArrow(pre_tokenise, found_schema)
        .withColumn("at", F.when(F.col("k") == 0, F.lit(0)).otherwise(joins))
        .withColumn("trusted", F.min(F.col("at").isNotNull()).over(so_far))
        .withColumn("at", F.when(F.col("trusted"), F.col("at")))
        .withColumn("end", F.coalesce(F.lead("at").over(in_order), F.lit(0)))
        .withColumn("last", F.lead("k").over(in_order).isNull())
        .withColumn("begin", F.coalesce("at", F.lit(0)))
        .withColumn("piece", F.max(F.when(F.col("trusted"), F.col("k"))).over(so_far))
        .withColumn("part", F.expr(f"substring(part, begin + 1, if(last, {chunk + overlap}, {chunk} + end) - begin)")))
    pieces = (stitched.groupBy("key", "digest", "piece").agg(
        F.max("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("k", "part"))).alias("parts"))
        .select("key", "digest", "piece", "copies", F.array_join("parts.part", "").alias("part")))
    out_schema = T.StructType([*name, *(T.StructField(n, t) for n, t in (
        ("piece", T.LongType()), ("copies", T.LongType()), ("n", T.LongType()), ("ids", T.StringType()),
        ("decoded", T.StringType())))])

    def encode(batches):
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for i, part in enumerate(batch.column(4).to_pylist()):
                ids = bpe.encode(part)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, 1) for c in batch.columns[:4]), pa.array([len(ids)], pa.int64()),
                     pa.array([bpe.listed(ids)]), pa.array([bpe.decode(ids).decode()])], names=out_schema.names)

    # Pieces of one text go to different tasks.
    spread = pieces.repartition(F.col("key"), F.col("digest"), F.col("piece"))
    joined = (spread.mapInArrow(encode, out_schema).groupBy("key", "digest").agg(
        F.sum("n").alias("n_tokens"), F.max("copies").alias("copies"),
        F.sort_array(F.collect_list(F.struct("piece", "ids", "decoded"))).alias("parts"))
        .select("key", "n_tokens", "copies", F.array_join("parts.ids", ",").alias("ids"),
                F.array_join("parts.decoded", "").alias("decoded")))
    out = [F.col("key").alias(key), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
           F.sha2("decoded", 256).alias("decoded_sha256")] + ["ids", "decoded"] * keep
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*out)
