"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and scored from mapped files.

Words are counted first, by 64-bit hashes, and numbered part by part in descending order of their counts, so that
frequent words have small numbers.  Tasks count the n-grams of their own texts and send sorted, compressed runs of
numbers and counts on; these are merged part by part, highest order first.  A merged part is written as a file with
its counts, and passes on what the order below needs: how many different words precede
each suffix (its Kneser-Ney count), and for each context its total and how many continuations were seen once, twice
or more.  Only n-grams at the start of a text have no word before them; of lower orders they alone are counted
as they stand.  Parts of the highest order are dealt out by context and suffix alike, so a context or a
suffix that holds a large share of all n-grams is spread over many.  Nothing is pruned.

A file holds the hashes of its n-grams in order: the first bits choose a bucket of about ten, 40 more are stored.  Of the
counts each different tuple is stored once, and each n-gram has its number in one to four bytes.

Workers map the files into memory and look up the sorted n-grams of many texts at once.  An unseen word gets its
share of the uniform distribution over the known words and one unknown word, so all probabilities sum to one.

Defined results: a null text counts as empty, that is one end token; texts with equal words score equally; with nothing to
learn from every token is the unknown word with probability one; an empty table gives no rows; texts that differ when they
are read again are an error.
"""

from __future__ import annotations

import functools
import json
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..plans.lineage import cut_lineage, scratch_path
from .common import mapped, new_file, write_file
from .packing import batches_of

ORDER = 2
PART_BYTES = 16 << 20  # training text per part of the lower orders
SUFFIX_SPLIT = 4  # parts of the highest order for each of these
LEAST_PARTS = 16
TOKENS_AT_ONCE = 4_000_000  # counted together inside a task
SCORED_AT_ONCE = 400_000
LONG_WORD = 256  # bytes; longer ones are hashed one by one

_MISSING = np.uint64(0xD1B54A32D192ED03)  # the number of every word that was not learned, of many bits as it is hashed with others
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_ROW = "n int, part int, kind string, columns array<binary>, note string"


def mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its first n-1 words and its last word."""
    with np.errstate(over="ignore"):
        x = first * np.uint64(0x9E3779B97F4A7C15) + second
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ x >> np.uint64(32)


def _special(name: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name)  # white space, which no word holds


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word of bytes in lower case that end in white space: its length and its bytes, eight at a time."""
    space = _IS_SPACE[np.frombuffer(data, np.uint8)]
    places = np.flatnonzero(~space & np.r_[True, space[:-1]])
    sizes = np.flatnonzero(space & np.r_[False, ~space[:-1]]) - places
    eights = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))
    out, live, used = sizes.astype(np.uint64), np.flatnonzero(sizes <= LONG_WORD), 0
    while len(live):
        left = sizes[live] - used
        out[live] = mix(out[live], eights[places[live] + used] & _FIRST_BYTES[np.minimum(left, 8)])
        live, used = live[left > 8], used + 8
    for at in np.flatnonzero(sizes > LONG_WORD).tolist():
        out[at] = _special(data[places[at]:places[at] + sizes[at]])
    return out, places


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        return int(_word_hashes(word + b"\n")[0][0])


_hashes = _Hashes()


def sequences(texts: list[str | None]):
    """Hashes of start, words and end of each text.  Words are cut at ASCII white space, A-Z in lower case."""
    texts = [t or "" for t in texts]
    for first, last in batches_of(texts):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts[first:last]]
        words, places = _word_hashes((b"\n".join(raw) + b"\n").lower())
        before = np.searchsorted(places, np.cumsum([len(x) + 1 for x in raw]))
        lengths = np.diff(before, prepend=0) + 2
        ends = np.cumsum(lengths)
        out, is_word = np.empty(int(ends[-1]), np.uint64), np.ones(int(ends[-1]), bool)
        is_word[ends - 1] = is_word[ends - lengths] = False
        out[ends - lengths], out[ends - 1], out[is_word] = _special(b"\r"), _special(b"\n"), words
        yield from np.split(out, ends[:-1])


# ------------------------------------------------------------------ runs of numbers

def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers as compressed byte planes; ascending ones by their differences."""
    import zstandard

    values = values.astype("<u8")
    if ascending:
        values = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(data: bytes, ascending: bool = False) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    values = np.ascontiguousarray(planes.T).view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def _grouped(keys: np.ndarray, *values: np.ndarray):
    """Different keys in order, and the sums of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], [np.add.reduceat(v[order], first) if len(first) else v for v in values]


def _dealt(part: np.ndarray):
    """``(part, rows)`` for every part, rows in their order."""
    part = part.astype(np.min_scalar_type(int(part.max())) if len(part) else np.uint8)  # 16 bits are sorted by radix
    order = np.argsort(part, kind="stable")
    ends = np.flatnonzero(np.r_[part[order][1:] != part[order][:-1], True][:len(part)]) + 1
    first = 0
    for end in ends.tolist():
        yield int(part[order[first]]), order[first:end]
        first = end


def _packs(words: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Columns of words put together into as few columns as hold them."""
    out = []
    for first in range(0, len(words), 64 // bits):
        code = words[first].astype(np.uint64)
        for more in words[first + 1:first + 64 // bits]:
            code = code << np.uint64(bits) | more
        out.append(code)
    return out


def _unpacks(packs: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    """The ``n`` columns of words that were put together."""
    per, mask, out = 64 // bits, np.uint64((1 << bits) - 1), []
    for at, code in enumerate(packs):
        held = min(per, n - at * per)
        out += [code >> np.uint64(bits * (held - 1 - k)) & mask for k in range(held)]
    return out


def _different(words: list[np.ndarray], bits: int, values=()):
    """Different n-grams in order, and the sums of each of the values; without values, how often each n-gram is there."""
    packs = _packs(words, bits)
    order = None
    if len(packs) == 1 and not values:
        packs = [np.sort(packs[0])]
    else:
        order = np.argsort(packs[0]) if len(packs) == 1 else np.lexsort(packs[::-1])
        packs = [p[order] for p in packs]
    new = np.zeros(len(packs[0]), bool)
    new[:1] = True
    for p in packs:
        new[1:] |= p[1:] != p[:-1]
    first = np.flatnonzero(new)
    sums = [np.add.reduceat(v[order], first) for v in values] if values else [np.diff(np.append(first, len(new)))]
    return _unpacks([p[first] for p in packs], len(words), bits), sums


def _gram_columns(words: list[np.ndarray], bits: int) -> list[bytes]:
    """N-grams in ascending order: their contexts, and the last word of each."""
    return [_packed(c, not at) for at, c in enumerate([*_packs(words[:-1], bits), words[-1]])]


def _grams_of(columns: list[bytes], n: int, bits: int) -> tuple[list[np.ndarray], list[bytes]]:
    """The words of a run of n-grams, and the columns after them."""
    used = -(-(n - 1) // (64 // bits)) + 1
    *packs, last = (_unpacked(c, not at) for at, c in enumerate(columns[:used]))
    return [*_unpacks(packs, n - 1, bits), last], columns[used:]


def _hash(words: list[np.ndarray]) -> np.ndarray:
    out = words[0]
    for more in words[1:]:
        out = mix(out, more)
    return out


def _row(n: int, part: int, kind: str, columns: list[bytes], note: str = "") -> dict:
    return {"n": n, "part": part, "kind": kind, "columns": columns, "note": note}


def _table(rows: list[dict]) -> pa.Table:
    schema = pa.schema([("n", pa.int32()), ("part", pa.int32()), ("kind", pa.string()),
                        ("columns", pa.list_(pa.binary())), ("note", pa.string())])
    return pa.Table.from_pylist(rows, schema=schema)


# ------------------------------------------------------------------ files

_HEAD = struct.Struct("<5Q")  # rows, bits that choose a bucket (0: no hashes), columns and number of tuples, bytes of a tuple's number
_files: dict[str, tuple] = {}


def _coded(values: list[np.ndarray]):
    """For each row the number of its tuple of values, and the different tuples."""
    code = values[0].astype(np.uint64)
    for v in values[1:]:
        if len(v) and (int(code.max()) + 1) * (int(v.max()) + 1) >> 63:
            code = np.unique(code, return_inverse=True)[1].astype(np.uint64)
        code = code * np.uint64(int(v.max(initial=0)) + 1) + v.astype(np.uint64)
    _, first, codes = np.unique(code, return_index=True, return_inverse=True)
    return codes, [v[first] for v in values]


def _write_counts(uri: str, hashes: np.ndarray | None, values: list[np.ndarray]) -> None:
    """Write tuples of values by hash, or in the order they are in."""
    bits, found = 0, []
    if hashes is not None:
        bits = max(1, (len(hashes) // 16).bit_length())
        order = np.argsort(hashes)
        hashes, values = hashes[order], [v[order] for v in values]
        starts = np.searchsorted(hashes >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        rest = hashes << np.uint64(bits)
        found = [starts.astype("<u4"), (rest >> np.uint64(32)).astype("<u4"), (rest >> np.uint64(24) & np.uint64(255)).astype("u1")]
    codes, tuples = _coded(values)
    width = np.min_scalar_type(max(len(tuples[0]) - 1, 0)).itemsize
    write_file(uri, [_HEAD.pack(len(codes), bits, len(tuples), len(tuples[0]), width), *(c.tobytes() for c in found),
                     *(t.astype("<u8").tobytes() for t in tuples), codes.astype(f"<u{width}").tobytes()])


def _arrays(uri: str, kinds) -> tuple:
    """The mapped arrays of one file, kept open by the worker; ``kinds`` gives the place of the first and the kind and length of each."""
    if uri not in _files:
        data = mapped(uri)
        place, plan = kinds(data)
        found = []
        for kind, count in plan:
            found.append(np.frombuffer(data, kind, count, place))
            place += found[-1].nbytes
        _files[uri] = tuple(found)
    return _files[uri]


def _count_arrays(data):
    rows, bits, columns, tuples, width = _HEAD.unpack(data[:_HEAD.size])
    keys = [("<u4", (1 << bits) + 1), ("<u4", rows), ("u1", rows)] if bits else []
    return _HEAD.size, [*keys, *[("<u8", tuples)] * columns, (f"<u{width}", rows)]


def _find(hashes: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Row of each hash in a file; the number of rows for one that is not there."""
    bits = (len(starts) - 1).bit_length() - 1
    bucket = hashes >> np.uint64(64 - bits)
    rest = hashes << np.uint64(bits)
    want, more = (rest >> np.uint64(32)).astype(np.uint32), (rest >> np.uint64(24) & np.uint64(255)).astype(np.uint8)
    first, end = starts[bucket].astype(np.int64), starts[bucket + np.uint64(1)].astype(np.int64)
    at, to = first, end
    for _ in range(int((end - first).max(initial=0)).bit_length()):
        middle = (at + to) >> 1
        less = low[np.minimum(middle, len(low) - 1)] < want
        open_ = at < to
        at, to = np.where(open_ & less, middle + 1, at), np.where(open_ & ~less, middle, to)
    out = np.full(len(hashes), len(low))
    live = np.flatnonzero(at < end)
    while len(live):  # once, unless several in a bucket agree in 32 bits
        live = live[low[at[live]] == want[live]]
        same = high[at[live]] == more[live]
        out[live[same]] = at[live[same]]
        live = live[~same]
        at[live] += 1
        live = live[at[live] < end[live]]
    return out


# ------------------------------------------------------------------ words

def _in_runs(rows_of):
    """A function over batches of texts that gives the rows of some millions of tokens at a time."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for found in sequences(batch.column(0).to_pylist()):
                held.append(found)
                size += len(found)
                if size >= TOKENS_AT_ONCE:
                    flat, lengths = np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))
                    held, size = [], 0
                    for row in rows_of(flat, lengths):
                        yield from _table([row]).to_batches()
        if held:
            for row in rows_of(np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))):
                yield from _table([row]).to_batches()

    return run


def _word_counter(parts: int):
    def rows_of(flat, lengths):
        words, counts = np.unique(flat, return_counts=True)
        for to, at in _dealt(words % np.uint64(parts)):
            yield _row(0, to, "A", [_packed(words[at], True), _packed(counts[at])])

    return _in_runs(rows_of)


def _settle_words(folder: str):
    def settle(table: pa.Table) -> pa.Table:
        runs = [[_unpacked(c, ascending=not at) for at, c in enumerate(columns)] for columns in table.column("columns").to_pylist()]
        words, (counts,) = _grouped(*(np.concatenate(c) for c in zip(*runs)))
        order = np.lexsort((words, -counts.astype(np.int64)))
        ranks = np.empty(len(words), "<u4")
        ranks[order] = np.arange(len(words))
        uri, kind = new_file(folder, ".words"), np.min_scalar_type(int(counts.max()))
        write_file(uri, [struct.pack("<QQ", len(words), kind.itemsize), words.astype("<u8").tobytes(), ranks.tobytes(),
                         counts[order].astype(f"<u{kind.itemsize}").tobytes()])
        note = {"part": table.column("part")[0].as_py(), "uri": uri, "words": len(words),
                "tokens": int(counts[words != np.uint64(_special(b"\r"))].sum())}
        return _table([_row(0, note["part"], "M", [], json.dumps(note))])

    return settle


def _word_arrays(data):
    rows, width = struct.unpack("<QQ", data[:16])
    return 16, [("<u8", rows), ("<u4", rows), (f"<u{width}", rows)]


class Words:
    """Numbers and counts of all words, in mapped files."""

    def __init__(self, parts: int, notes: list[dict]):
        self.parts = parts
        self.uris = {x["part"]: x["uri"] for x in notes}
        self.sizes = {x["part"]: x["words"] for x in notes}
        self.tokens = sum(x["tokens"] for x in notes)
        self.bits = max([1, *(((x["words"] - 1) * parts + x["part"]).bit_length() for x in notes)])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each word; a number of its own and 0 for words that were not learned."""
        numbers, counts = np.full(len(hashes), _MISSING), np.zeros(len(hashes), np.int64)
        for to, at in _dealt(hashes % np.uint64(self.parts)):
            if to in self.uris:
                words, ranks, raw = _arrays(self.uris[to], _word_arrays)
                rows = np.minimum(np.searchsorted(words, hashes[at]), len(words) - 1)
                hit = words[rows] == hashes[at]
                rank = ranks[rows[hit]]
                numbers[at[hit]] = rank.astype(np.uint64) * np.uint64(self.parts) + np.uint64(to)
                counts[at[hit]] = raw[rank]
        return numbers, counts


# ------------------------------------------------------------------ counting

def _top_part(ctx: np.ndarray, suf: np.ndarray, parts: int) -> np.ndarray:
    return (ctx % np.uint64(parts)).astype(np.int64) * SUFFIX_SPLIT + (suf % np.uint64(SUFFIX_SPLIT)).astype(np.int64)


def _part(n: int, order: int, words: list[np.ndarray], parts: int) -> np.ndarray:
    return _top_part(_hash(words[:-1]), _hash(words[1:]), parts) if n == order else _hash(words) % np.uint64(parts)


def _gram_rows(n: int, order: int, parts: int, bits: int, kind: str, words: list[np.ndarray], values: list[np.ndarray]):
    """Rows that bring sorted n-grams and their values to their parts."""
    for to, at in _dealt(_part(n, order, words, parts)):
        yield _row(n, to, kind, [*_gram_columns([w[at] for w in words], bits), *(_packed(v[at]) for v in values)])


def _counter(order: int, learned: Words):
    def rows_of(flat, lengths):
        names, back = np.unique(flat, return_inverse=True)
        numbers, _ = learned.find(names)
        if (numbers == _MISSING).any():
            raise ValueError("the texts differ from those whose words were counted")
        numbers = numbers[back]
        ends = np.cumsum(lengths)
        for n in range(2, order + 1):
            if n == order:
                first = np.flatnonzero(np.repeat(ends, lengths) - np.arange(len(flat)) >= n)
            else:  # any other has a word before it and is counted by these
                first = (ends - lengths)[lengths >= n]
            words, counts = _different([numbers[first + k] for k in range(n)], learned.bits)
            yield from _gram_rows(n, order, learned.parts, learned.bits, "A", words, counts)

    return _in_runs(rows_of)


def _settle(level: int, order: int, learned: Words, folder: str):
    """Merge the parts of one order; rows of lower orders and of finished files pass through."""
    parts, bits, sizes = learned.parts, learned.bits, learned.sizes

    def settle(table: pa.Table) -> pa.Table:
        n = table.column("n")[0].as_py()
        if n != level:
            return table
        part = table.column("part")[0].as_py()
        runs = [(kind == "X", *_grams_of(columns, n, bits))
                for kind, columns in zip(table.column("kind").to_pylist(), table.column("columns").to_pylist())]

        def column(k: int) -> np.ndarray:
            """Counts (0), or what the n-grams are as contexts; one of them is held at a time."""
            found = [_unpacked(columns[max(k - 1, 0)]) if is_context == (k > 0) else np.zeros(len(words[-1]), np.uint64)
                     for is_context, words, columns in runs]
            return np.concatenate(found).astype(np.int64)

        words, values = _different([np.concatenate(w) for w in zip(*(words for _, words, _ in runs))], bits,
                                   _Columns(column, 1 if n == order else 5))
        if n == 1:  # every word of the part, by its rank; the start is only a context
            rank, (words, found) = (words[0] // np.uint64(parts)).astype(np.int64), (words, values)
            values = [np.zeros(sizes[part], np.int64) for _ in found]
            for to, v in zip(values, found):
                to[rank] = v
        counts = values[0]
        uri = new_file(folder, f".{n}")
        _write_counts(uri, _hash(words) if n > 1 else None, values)
        note = {"n": n, "part": part, "uri": uri, "t": [int((counts == k).sum()) for k in (1, 2, 3, 4)],
                "entries": int((counts > 0).sum()), "sum": int(counts.sum())}
        out = [_row(0, part % parts, "M", [], json.dumps(note))]
        if n > 1:
            lower = functools.partial(_gram_rows, n - 1, order, parts, bits)
            out += lower("X", *_different(words[:-1], bits, [counts, *(x.astype(np.int64) for x in (counts == 1, counts == 2, counts > 2))]))
            out += lower("C", *_different(words[1:], bits))
        return _table(out)

    return settle


class _Columns:
    """Columns made when they are asked for."""

    def __init__(self, make, count: int):
        self.make, self.count = make, count

    def __iter__(self):
        return map(self.make, range(self.count))


def train(texts: DataFrame, text: str = "text", order: int = ORDER, part_bytes: int = PART_BYTES) -> "Model":
    """Count, write and describe the model of all texts."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-size // part_bytes))
    folder = scratch_path(texts.sparkSession, "ngrams")

    def notes(rows: DataFrame) -> list[dict]:
        # A row of some hundred bytes per file, that is per million n-grams.
        return [json.loads(r["note"]) for r in cut_lineage(rows.where(F.col("kind") == "M").select("note"), "model").collect()]

    words = texts.select(text).mapInArrow(_word_counter(parts), _ROW)
    learned = Words(parts, notes(words.groupBy("part").applyInArrow(_settle_words(folder), _ROW)))
    rows = texts.select(text).mapInArrow(_counter(order, learned), _ROW)
    for level in range(order, 0, -1):
        rows = rows.groupBy("n", "part").applyInArrow(_settle(level, order, learned, folder), _ROW)
    return Model(order, learned, notes(rows))


# ------------------------------------------------------------------ scoring

class Model:
    """Where the files are, and the few numbers that hold for all n-grams."""

    def __init__(self, order: int, learned: Words, notes: list[dict]):
        self.order, self.learned = order, learned
        self.uris = {(x["n"], x["part"]): x["uri"] for x in notes}
        self.discounts = {n: discounts([sum(x["t"][k] for x in notes if x["n"] == n) for k in range(4)]) for n in range(1, order + 1)}
        words = [x for x in notes if x["n"] == 1]
        self.vocabulary = sum(x["entries"] for x in words)  # the start is never predicted: its count is 0
        self.sum = sum(x["sum"] for x in words)
        once, twice = (sum(x["t"][k] for x in words) for k in (0, 1))
        self.spare = float(np.dot(self.discounts[1][1:], [once, twice, self.vocabulary - once - twice]) / self.sum) if self.sum else 1.0

    def _values(self, n: int, part: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Count and, below the highest order, total and continuations seen once, twice, more of n-grams; 0 for those not learned."""
        out = np.zeros((1 if n == self.order else 5, len(hashes)), np.int64)
        for to, at in _dealt(part):
            if (n, to) in self.uris:
                *keys_and_values, codes = _arrays(self.uris[n, to], _count_arrays)
                values = keys_and_values[-len(out):]
                if n == 1:
                    at = at[hashes[at] != _MISSING]
                    code = codes[(hashes[at] // np.uint64(self.learned.parts)).astype(np.int64)]
                else:
                    rows = _find(hashes[at], *keys_and_values[:3])
                    at, rows = at[rows < len(codes)], rows[rows < len(codes)]
                    code = codes[rows]
                for row, value in zip(out, values):
                    row[at] = value[code]
        return out

    def counts(self, *words: np.ndarray) -> np.ndarray:
        """Counts of n-grams of the highest order, given the hashes of their words."""
        numbers = [self.learned.find(w)[0] for w in words]
        return self._values(self.order, _part(self.order, self.order, numbers, self.learned.parts), _hash(numbers))[0]

    def totals(self) -> tuple[int, int]:
        """Tokens and different tokens that were learned from."""
        return self.learned.tokens, self.vocabulary

    def score(self, sequences: list[np.ndarray]):
        """For each text: tokens, known tokens, base score, score (both log10)."""
        flat = np.concatenate(sequences)
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        ends = np.cumsum(lengths)
        place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
        tokens = np.flatnonzero(place > 0)
        text = np.repeat(np.arange(len(sequences)), lengths)[tokens]
        all_tokens, vocabulary = self.totals()

        names, back = np.unique(flat, return_inverse=True)
        numbers, own = self.learned.find(names)
        counts, *stats = self._values(1, numbers % np.uint64(self.learned.parts), numbers)
        p = ((np.maximum(counts - self.discounts[1][np.minimum(counts, 3)], 0) / max(self.sum, 1)
              + self.spare / (vocabulary + 1))[back])[tokens]
        own = own[back][tokens]
        base = np.log10((own + 1) / (all_tokens + vocabulary + 1))
        stats = np.stack(stats)[:, back]  # of the n-gram that ends at each place, as a context
        numbers = hashes = numbers[back]
        for n in range(2, self.order + 1):
            whole = np.flatnonzero(place[tokens] >= n - 1)
            last = tokens[whole]
            ctx, suf = hashes[last - (n - 1)], hashes[last - (n - 2)]
            grams, index, pair = np.unique(mix(ctx, numbers[last]), return_index=True, return_inverse=True)
            part = (_top_part(ctx[index], suf[index], self.learned.parts) if n == self.order else grams % np.uint64(self.learned.parts))
            values = self._values(n, part, grams)
            counts, (total, *continued) = values[0][pair], stats[:, last - 1]
            seen = total > 0
            discount = self.discounts[n]
            back_off = sum(d * c for d, c in zip(discount[1:], continued))  # a library's product would start threads
            divisor = np.where(seen, total, 1)
            higher = (np.maximum(counts - discount[np.minimum(counts, 3)], 0) + back_off * p[whole]) / divisor
            p[whole] = np.where(seen, higher, p[whole])
            if n < self.order:
                stats = np.zeros((4, len(flat)), np.int64)
                stats[:, last] = values[1:, pair]
                hashes = np.append(mix(hashes[:len(hashes) - (n - 1)], numbers[n - 1:]), np.zeros(n - 1, np.uint64))
        sums = [np.bincount(text, weights=w, minlength=len(sequences)) for w in ((own > 0).astype(float), base, np.log10(p))]
        return lengths - 1, sums[0].astype(np.int64), sums[1], sums[2]


def discounts(t: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2, 3 or more; fixed ones where too little was seen to estimate them."""
    if min(t[:3]) > 0:
        y = t[0] / (t[0] + 2 * t[1])
        found = [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)]
        if all(0 <= d <= k for k, d in enumerate(found, 1)):
            return np.array([0.0, *found])
    return np.array([0.0, 0.5, 1.0, 1.5])


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns with ``n_tokens, n_known, train_tokens, base_score, score``; columns of these names are replaced."""
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
                           T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    place = docs.columns.index(text)

    def score(batches):
        for batch in batches:
            hashed = list(sequences(batch.column(place).to_pylist()))
            at = 0
            while at < len(hashed):
                end, size = at, 0
                while end < len(hashed) and (end == at or size + len(hashed[end]) <= SCORED_AT_ONCE):
                    size += len(hashed[end])
                    end += 1
                found = model.score(hashed[at:end])
                learned = np.full(end - at, model.totals()[0])
                columns = [found[0], found[1], learned, found[2], found[3]]
                yield pa.RecordBatch.from_arrays([*batch.slice(at, end - at).columns, *map(pa.array, columns)], names=schema.names)
                at = end

    return docs.mapInArrow(score, schema)
