"""BPE encoding and decoding of words by an index from pairs to their positions.

All pieces of a slice of texts that are not kept yet lie in one row of symbols, with gaps between pieces.  The index
maps the rank of each mergeable pair to all positions where the pair stands.  Active ranks are applied in ascending
order: the pair at each listed position becomes one symbol, its two neighbours form new pairs, and these positions go to the lists
of their ranks.  Positions whose pair has changed in the meantime are passed over when their list is read.  Since a file's merges only build
on symbols made by earlier ones (checked when it is read), this gives each piece the ids it has when merged on its own.

What surrounds the merges, that is special tokens, normaliser, pre-tokeniser and the words kept per worker, is that of
``tokens.WordBpe``.  Decoding writes the tokens with blanks between them, as the library does for a file without a decoder.

Defined results: a null text counts as empty (no ids); special tokens written out in a text become their ids; equal rows are encoded row by
row; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .common import texts_of
from .packing import batches_of
from .tokens import WordBpe, byte_letters

TEXTS_AT_ONCE = 1 << 21  # characters whose pieces are indexed together
SYMBOLS_AT_ONCE = 1 << 21  # bytes of pieces in one index at most, unless one piece has more
IDS_AT_ONCE = 1 << 16  # decoded together

_GAP, _GONE = -1, -2


class Merges:
    """Ranks of pairs, the symbols they become, and the symbols of single bytes."""

    def __init__(self, model: dict):
        if model.get("continuing_subword_prefix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("a file with a prefix of inner parts, dropout or unmerged words is not supported")
        ids, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.width = max(ids.values()) + 2
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = [ids[a] for a, _ in pairs]
        self.right = [ids[b] for _, b in pairs]
        self.made = [ids[a + b] for a, b in pairs]
        self.rank = {a * self.width + b: r for r, (a, b) in enumerate(zip(self.left, self.right))}
        last = {}
        for rank, symbol in enumerate(self.made):
            last[symbol] = rank
        if any(last.get(s, -1) >= r for r, (a, b) in enumerate(zip(self.left, self.right)) for s in (a, b)):
            raise ValueError("a merge builds on a symbol that a later one makes: ranks cannot be applied in ascending order")
        letters = byte_letters()
        # Symbols of bytes inside a piece, then of bytes that end it.
        self.symbols = np.array([ids[letters[b]] for b in range(256)] + [ids[letters[b] + end] for b in range(256)], np.int32)
        at = {s: i for i, s in enumerate(self.symbols.tolist())}
        self.first_ranks = np.full((512, 512), -1, np.int32)
        for r, (a, b) in enumerate(zip(self.left, self.right)):
            if a in at and b in at:
                self.first_ranks[at[a], at[b]] = r

    def apply(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has."""
        raw = np.frombuffer(("\n" + "\n".join(pieces) + "\n").encode("utf-8", "surrogatepass"), np.uint8)
        gaps = raw == 10
        kind = raw.astype(np.int32)
        kind[:-1][gaps[1:]] += 256
        symbols = np.where(gaps, _GAP, self.symbols[kind % 512])
        ranks = np.where(gaps[:-1] | gaps[1:], -1, self.first_ranks[kind[:-1] % 512, kind[1:] % 512])
        at = array("i", symbols.astype(np.int32).tobytes())
        self._merge(at, ranks)
        done = np.frombuffer(at, np.int32)
        done = done[done != _GONE]
        ends = np.flatnonzero(done == _GAP)
        return done[done != _GAP], np.diff(ends) - 1

    def _merge(self, at: array, ranks: np.ndarray) -> None:
        size = len(at)
        after, before = array("i", range(1, size + 1)), array("i", range(-1, size - 1))
        places = np.flatnonzero(ranks >= 0)
        places = places[np.argsort(ranks[places], kind="stable")]
        active, first = np.unique(ranks[places], return_index=True)
        index = {rank: part.tolist() for rank, part in zip(active.tolist(), np.split(places, first[1:]))}
        waiting = list(index)
        heapify(waiting)
        rank_of, width, left, right, made = self.rank.get, self.width, self.left, self.right, self.made
        while waiting:
            rank = heappop(waiting)
            found, a, b, new = index.pop(rank), left[rank], right[rank], made[rank]
            if a == b:  # of overlapping pairs the first one is merged
                found.sort()
            for place in found:
                if at[place] != a:
                    continue
                second = after[place]
                if at[second] != b:
                    continue
                at[place], at[second] = new, _GONE
                following, previous = after[second], before[place]
                after[place], before[following] = following, place
                if at[previous] >= 0 and (to := rank_of(at[previous] * width + new)) is not None:
                    if to in index:
                        index[to].append(previous)
                    else:
                        index[to] = [previous]
                        heappush(waiting, to)
                if at[following] >= 0 and (to := rank_of(new * width + at[following])) is not None:
                    if to in index:
                        index[to].append(place)
                    else:
                        index[to] = [place]
                        heappush(waiting, to)


class PairIndexBpe(WordBpe):
    """Encodes by the pair index and decodes; the file has to be one of byte-level words with an end mark."""

    def __init__(self, path: str, **limits):
        super().__init__(path, **limits)
        if self.pattern is None:
            raise ValueError(f"not a file of byte-level words with an end mark: {path}")
        self.merges = Merges(self.spec["model"])
        names = {**self.spec["model"]["vocab"], **self.special}
        self.names = [""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.names[number] = name

    def piece_ids(self, pieces):
        parts = [self.merges.apply(pieces[a:b]) for a, b in batches_of(pieces, SYMBOLS_AT_ONCE)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def decoded(self, ids: np.ndarray):
        """The text of ids, in parts."""
        for first in range(0, len(ids), IDS_AT_ONCE):
            part = " ".join(map(self.names.__getitem__, ids[first:first + IDS_AT_ONCE].tolist()))
            yield " " + part if first else part


_workers: dict[str, PairIndexBpe] = {}


def _encoder(path: str) -> PairIndexBpe:
    if path not in _workers:
        _workers[path] = PairIndexBpe(path)
    return _workers[path]


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """Key, ``n_tokens, ids_sha256, decoded_sha256`` of every text and, if asked for, ``ids`` and ``decoded``."""
    fields = [T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields)

    def rows_of(encoder, keys, ids, counts):
        columns = [[], [], [], [], []]
        ends = np.cumsum(counts)
        for end, count in zip(ends.tolist(), counts.tolist()):
            own = ids[end - count:end].astype("<u4")
            digest, parts = hashlib.sha256(), []
            for part in encoder.decoded(own):
                digest.update(part.encode())
                parts += [part] if keep else []
            for column, value in zip(columns, (hashlib.sha256(own.tobytes()).hexdigest(), digest.hexdigest(),
                                               own.astype(np.int32), "".join(parts))):
                column.append(value)
        made = [keys, pa.array(counts, pa.int64()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string())]
        if keep:
            made += [pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.string())]
        return pa.RecordBatch.from_arrays(made, names=schema.names)

    def encode(batches):
        encoder = _encoder(path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, last in batches_of(texts, TEXTS_AT_ONCE):
                found = (encoder.encode_long(texts[first], TEXTS_AT_ONCE) if last == first + 1
                         else encoder.encode(texts[first:last]))
                yield rows_of(encoder, batch.column(0).slice(first, last - first), *found)

    return docs.select(key, text).mapInArrow(encode, schema)
