"""Token ids in binary files: fixed-size blocks, byte planes, zstandard, a chunk index.

A file holds the ids of consecutive documents.  Each block of ``BLOCK`` ids (the last is shorter)
is transposed into four byte planes, lowest byte first, each compressed on its own; equal high
bytes then cost next to nothing.  After the blocks come the index, the document table (Arrow, any key
type) and a footer, so a reader can go straight to any block::

    magic | planes of block 0 | planes of block 1 | ... | index | document table | lengths | magic

``write_ids`` sorts documents by key over the whole cluster and lets each task write one file, of which there are more
in a larger table;
``read_ids`` reads the files back block by block.  Neither holds more than a block and a batch.

Defined results: a null text counts as empty (its end id alone is written); null keys come first; rows with
one key stand next to each other, ordered by a hash of the text; an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..plans.lineage import cut_lineage, scratch_path
from ..plans.sizing import estimated_bytes
from .common import free_name, new_file, open_file, texts_of, write_file
from .packing import encoded

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
FILE_BYTES = 64 << 20  # of the table, as the planner expects it, per file at most
KEPT_WORDS = 450_000  # per half: nothing else here takes memory beside the encoder
MOST_TASKS = 10_000  # each reads several files beyond that
ENTRY = struct.Struct("<QI4I")  # place in the file, ids, compressed bytes of each plane
FOOTER = struct.Struct("<QQQ")  # place of the index, blocks, place of the document table


def to_planes(ids: np.ndarray) -> list[bytes]:
    return [plane.tobytes() for plane in ids.astype("<u4").view(np.uint8).reshape(-1, 4).T]


def from_planes(planes: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(p, np.uint8) for p in planes], 1).copy().view("<u4").ravel()


class _Writer:
    def __init__(self):
        import zstandard

        self.zip = zstandard.ZstdCompressor(level=3)
        self.waiting, self.held, self.place, self.index = [], 0, len(MAGIC), []

    def add(self, ids: np.ndarray):
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= BLOCK:
            yield from self._blocks(False)

    def _blocks(self, last: bool):
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        whole = len(ids) if last else len(ids) - len(ids) % BLOCK
        for first in range(0, whole, BLOCK):
            block = ids[first:min(first + BLOCK, whole)]
            planes = [self.zip.compress(p) for p in to_planes(block)]
            self.index.append(ENTRY.pack(self.place, len(block), *map(len, planes)))
            self.place += sum(map(len, planes))
            yield from planes
        self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def end(self, table: pa.Table):
        yield from self._blocks(True)
        index = b"".join(self.index)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        yield index
        yield sink.getvalue().to_pybytes()
        yield FOOTER.pack(self.place, len(self.index), self.place + len(index))
        yield MAGIC


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """Write the ids of all texts under ``folder``; returns one row per file.

    Columns: ``file_no`` (files in key order), ``uri``, ``documents``, ``ids``, ``first_id`` (ids in all files before).
    """
    tie = free_name([key, text], "__tie")
    order = [F.col(key).asc_nulls_first(), F.xxhash64(text), F.col(tie)]
    size = estimated_bytes(docs.select(key, text))
    size = 0 if size > 1 << 60 else size  # the planner knows nothing of it
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))
    ordered = (docs.select(key, text).withColumn(tie, F.monotonically_increasing_id())
               .repartitionByRange(files, *order).sortWithinPartitions(*order).select(key, text))

    def write(batches):
        from pyspark import TaskContext

        totals, tables, uri = [0, 0], [], new_file(folder, ".ids")

        def chunks():
            writer = _Writer()
            yield MAGIC
            for batch in batches:
                texts, counts = texts_of(batch.column(1)), []
                for _, ids in encoded(texts, path, end_id, KEPT_WORDS):
                    counts.append(len(ids))
                    yield from writer.add(ids)
                totals[0] += len(texts)
                totals[1] += sum(counts)
                tables.append(pa.table({"key": batch.column(0), "n": pa.array(counts, pa.int64())}))
            if tables:
                yield from writer.end(pa.concat_tables(tables))

        made = chunks()
        head = [next(made)]
        head += [c for c in [next(made, None)] if c is not None]
        if len(head) > 1 or tables:
            write_file(uri, _chain(head, made))
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([TaskContext.get().partitionId()], pa.int64()), "uri": pa.array([uri]),
                "documents": pa.array([totals[0]], pa.int64()), "ids": pa.array([totals[1]], pa.int64())})

    files = cut_lineage(ordered.mapInArrow(write, "file_no long, uri string, documents long, ids long"), "idfiles")
    # One row per file: this window is over files, not over documents.
    before = F.sum("ids").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("first_id", F.coalesce(before, F.lit(0)))


def _chain(head, rest):
    yield from head
    yield from rest


class IdFile:
    """One file, read block by block."""

    def __init__(self, uri: str):
        import zstandard

        self.unzip = zstandard.ZstdDecompressor()
        self.file = open_file(uri)
        tail = FOOTER.size + len(MAGIC)
        size = self.file.size()
        foot = self._at(size - tail, tail)
        if foot[FOOTER.size:] != MAGIC or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"not an id file, or cut short: {uri}")
        index, blocks, table = FOOTER.unpack(foot[:FOOTER.size])
        self.index = list(ENTRY.iter_unpack(self._at(index, table - index)))
        assert len(self.index) == blocks
        self.documents = pa.ipc.open_stream(self._at(table, size - tail - table)).read_all()

    def _at(self, place: int, length: int) -> bytes:
        self.file.seek(place)
        return self.file.read(length)

    def block(self, number: int) -> np.ndarray:
        place, _, *lengths = self.index[number]
        data, planes = self._at(place, sum(lengths)), []
        for length in lengths:
            planes.append(self.unzip.decompress(data[:length]))
            data = data[length:]
        return from_planes(planes)

    def runs(self):
        """``(document's row, its ids or a part of them, whether this is the last part)``."""
        counts = self.documents.column("n").to_numpy()
        block, number, used = np.empty(0, "<u4"), 0, 0
        for row, count in enumerate(counts.tolist()):
            while True:
                if used == len(block) and count:
                    block, number, used = self.block(number), number + 1, 0
                part = block[used:used + count]
                used, count = used + len(part), count - len(part)
                yield row, part, not count
                if not count:
                    break


def read_ids(files: DataFrame, key_type: T.DataType, key: str = "doc_id") -> DataFrame:
    """One row per document of the files: key, ``start``, ``n_tokens``, ``ids_crc32``."""
    schema = T.StructType([T.StructField(key, key_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file, sums, crc = IdFile(row["uri"]), [], 0
                for _, part, last in file.runs():
                    crc = zlib.crc32(part.tobytes(), crc)
                    if last:
                        sums.append(crc)
                        crc = 0
                counts = file.documents.column("n").to_numpy()
                starts = row["first_id"] + np.cumsum(counts) - counts
                for part in pa.table([file.documents.column("key"), pa.array(starts), pa.array(counts),
                                      pa.array(sums, pa.int64())], names=schema.names).to_batches(8192):
                    yield part

    # About a file a task: files are as large as the sorted partitions that wrote them.
    tasks = max(1, min(files.count(), MOST_TASKS))
    return files.select("uri", "first_id").repartition(tasks, "uri").mapInArrow(read, schema)


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write all ids to the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-ids")
    files = write_ids(docs, folder, path, end_id)
    return read_ids(files, docs.schema["doc_id"].dataType)
