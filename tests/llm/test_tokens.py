"""Packing, id files and byte-level BPE: against the libraries themselves, and round trips."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm_rows import ROWS
from statlake.llm import bytebpe, idfiles, packing
from statlake.llm.tokens import WordBpe

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EDGES = ["", "  a\x1cb c ́x <|endoftext|> İSTANBUL ΣΑΣ", "\n\n '’s don't", "a" * 3000, "漢字かな交じり文   x", " ", "  x"]


@pytest.fixture(scope="module")
def plain():
    encoder = Tokenizer.from_file(WORDS)
    return lambda text, end: [*encoder.encode(text or "", add_special_tokens=False).ids, end]


def test_words_encoded_once_give_the_library_s_ids(plain):
    texts = EDGES + [t or "" for _, t, _ in ROWS]
    for kept in (1, 10, 10_000):
        encoder = WordBpe(WORDS, kept)
        for part in (texts[:4], texts[4:], texts, *([t] for t in texts), texts[::-1]):
            ids, counts = encoder.encode(part)
            assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t, 0)[:-1] for t in part]


@pytest.mark.parametrize("blank", ["\r", "\t", "\xa0", "\x85", "\u2003", "\u3000", "\x0b\x0c"])
def test_words_of_white_space_do_not_shift_their_neighbours(plain, blank):
    encoder = WordBpe(WORDS)
    texts = [f"first {blank} second third col{blank}val end", f"first second third end {blank}", f"x{blank}y third", blank, "second"]
    for part in (texts[:1], texts):
        ids, counts = encoder.encode(part)
        assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t, 0)[:-1] for t in part]


@pytest.mark.parametrize("most", [1, 7, 50, 10**6])
def test_long_texts_are_encoded_in_parts(plain, most):
    encoder = WordBpe(WORDS)
    for text in [*EDGES, "one two  three " * 20, "x" * 300]:
        ids, counts = encoder.encode_long(text, most)
        assert list(ids) == plain(text, 0)[:-1] and counts.tolist() == [len(ids)]


def test_a_tokenizer_that_keeps_blanks_gets_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Tokenizer.from_file(path)
    ids, counts = WordBpe(path).encode(EDGES)
    assert list(ids) == [i for t in EDGES for i in encoder.encode(t, add_special_tokens=False).ids] and len(counts) == len(EDGES)


def test_first_fit_decreasing_matches_a_scan():
    sizes = np.random.default_rng(3).integers(1, 101, 400)
    bins, offsets = packing.first_fit(sizes, 100)
    room, want = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        b = next((b for b, free in enumerate(room) if free >= sizes[i]), None)
        if b is None:
            room.append(100)
            b = len(room) - 1
        want[i] = (b, 100 - room[b])
        room[b] -= sizes[i]
    assert [(b, o) for b, o in zip(bins, offsets)] == [want[i] for i in range(len(sizes))]


@pytest.mark.parametrize("group_rows", [3, 2048])
def test_every_id_is_packed_once(spark, documents, plain, group_rows):
    got = packing.pack(packing.token_pieces(documents(ROWS, True), WORDS, 2, keep_ids=True), group_rows=group_rows).collect()
    want = Counter()
    for key, text, _ in ROWS:
        ids = plain(text, 2)
        for start in range(0, len(ids), 4096):
            want[key, start, tuple(ids[start:start + 4096]), len(ids)] += 1
    assert Counter((r.doc_id, r.start, tuple(r.ids), r.doc_tokens) for r in got) == want
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.length == len(r.ids) for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_nothing(spark, documents):
    assert packing.pack(packing.token_pieces(documents([]), WORDS, 2)).count() == 0


def test_planes_round_trip():
    for ids in (np.array([], "<u4"), np.array([0, 1, 2**32 - 1, 77], "<u4"), np.arange(70_000, dtype="<u4")):
        assert (idfiles.from_planes(idfiles.to_planes(ids)) == ids).all()


def test_id_files_round_trip(spark, documents, plain, tmp_path):
    df = documents(ROWS, True).repartition(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = idfiles.write_ids(df, str(tmp_path / "ids"), WORDS, 1)
        assert files.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = idfiles.read_ids(files, df.schema["doc_id"].dataType).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    keys = [r[0] for r in order]
    assert sorted((r.start, r.doc_id) for r in got)[0][0] == 0 and [k for _, k in sorted(
        (r.start, r.doc_id) for r in got if r.doc_id is not None)] == [k for k in keys if k is not None]
    want = Counter()
    for key, text, _ in ROWS:
        ids = np.array(plain(text, 1), "<u4")
        want[key, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_no_documents_write_no_file(spark, documents, tmp_path):
    files = idfiles.write_ids(documents([]), str(tmp_path / "none"), WORDS, 1)
    assert files.count() == 0 and idfiles.read_ids(files, documents([]).schema["doc_id"].dataType).count() == 0


def test_a_cut_file_is_refused(tmp_path):
    path = tmp_path / "cut.ids"
    path.write_bytes(idfiles.MAGIC + b"\0" * 64)
    with pytest.raises(ValueError, match="cut short"):
        idfiles.IdFile(str(path))


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (200, 50), (1 << 15, 512)])
def test_byte_bpe_of_stitched_chunks(spark, documents, chunk, overlap):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = ROWS + [(100 + i, t, "en") for i, t in enumerate([*EDGES, "don't we'll " * 20, " " * 200 + "x", "ab 're  \n\n  c's" * 30])]
    if chunk < 1000:
        rows = [(k, t[:3000] if t else t, x) for k, t, x in rows]
    got = bytebpe.encode_texts(documents(rows, True), RANKS, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap, keep=True).collect()
    want = Counter()
    for key, text, _ in rows:
        ids = own.encode_ordinary(text or "")
        want[key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest(), text or ""] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) for r in got) == want


def test_byte_bpe_of_nothing(spark, documents):
    assert bytebpe.encode_texts(documents([]), RANKS, public_tokenizers.PATTERN).count() == 0


def test_only_words_beyond_ascii_or_with_white_space_reach_the_normaliser():
    import public_tokenizers
    from statlake.llm.tokens import WordBpe
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, given = WordBpe(path), []
    joined = encoder._normalised_joined
    encoder._normalised_joined = lambda words: given.extend(words) or joined(words)
    text = "The QUICK fox's tab\tbed naïve STRASSE Straße İI Kelvin café a\x85b \x1cx\x1f <|endoftext|> end"
    ids, counts = encoder.encode([text, "", "plain Words"])
    want = [e.ids for e in encoder.tokenizer.encode_batch([text, "", "plain Words"], add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    assert sorted(given) == sorted(["tab\tbed", "naïve", "Straße", "İI", "Kelvin", "café", "a\x85b", "\x1cx\x1f"])


def test_pieces_leave_nothing_to_the_garbage_collector():
    import gc

    encoder, held = WordBpe(WORDS), []
    pieces = [f"piece{x}" for x in range(20_000)]
    tokenize, gc_was_on = encoder.tokenizer.model.tokenize, gc.isenabled()
    gc.collect()
    gc.callbacks.append(lambda phase, info: held.append(phase))
    try:
        ids, sizes = encoder.piece_ids(pieces)
    finally:
        gc.callbacks.pop()
    assert gc_was_on and len(held) <= 4
    want = [[t.id for t in tokenize(p)] for p in pieces]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
