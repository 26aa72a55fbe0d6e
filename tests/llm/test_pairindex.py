"""BPE by the pair index: against the library, with ids and decoding."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from llm_rows import ROWS
from statlake.llm import pairindex

PATH = public_tokenizers.path("word_bpe_49k.json")
EDGES = ["", " ", "a" * 3001, "aaaa aaa aa a", "a<|endoftext|><|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> <|endof<|endoftext|>text|>",
         "ΣΑΣ İß don't'll 3.14159 ___ '''", "\x1c\x85 \tx\r\ny", "漢字かな交じり文", "🙂🙃" * 40, "été é ́"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("limits", [{}, {"kept": 1}, {"kept": 5}])
def test_ids_and_decoding_are_the_library_s(library, limits):
    encoder = pairindex.PairIndexBpe(PATH, **limits)
    texts = EDGES + [t or "" for _, t, _ in ROWS]
    for part in (texts, texts[::-1], *([t] for t in texts)):
        ids, counts = encoder.encode(part)
        for text, own in zip(part, np.split(ids, np.cumsum(counts)[:-1])):
            want = library.encode(text, add_special_tokens=False).ids
            assert list(own) == want
            assert "".join(encoder.decoded(own)) == library.decode(want, skip_special_tokens=False)


_encoder = pairindex.PairIndexBpe(PATH, kept=50)
_library = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_any_text(texts):
    ids, counts = _encoder.encode(texts) if texts else ([], [])
    assert list(ids) == [i for t in texts for i in _library.encode(t, add_special_tokens=False).ids]


def test_merges_out_of_order_are_refused(tmp_path):
    spec = json.load(open(PATH))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    with pytest.raises(ValueError, match="later one makes"):
        pairindex.Merges(spec["model"])
    with pytest.raises(ValueError, match="end mark"):
        pairindex.PairIndexBpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_an_index_of_several_slices(monkeypatch, library):
    monkeypatch.setattr(pairindex, "SYMBOLS_AT_ONCE", 10)
    monkeypatch.setattr(pairindex, "IDS_AT_ONCE", 3)
    encoder = pairindex.PairIndexBpe(PATH)
    text = "one two three, fourteen hundred and ninety-two sailed"
    ids, _ = encoder.encode([text])
    want = library.encode(text, add_special_tokens=False).ids
    assert list(ids) == want and "".join(encoder.decoded(ids)) == library.decode(want, skip_special_tokens=False)


def test_texts_of_a_table(spark, documents, library):
    rows = ROWS + [(100 + i, t, "en") for i, t in enumerate(EDGES)]
    got = pairindex.encode_texts(documents(rows, True).repartition(3), PATH, keep=True).collect()
    want = Counter()
    for key, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(),
             tuple(ids), decoded] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), r.decoded) for r in got) == want
    assert pairindex.encode_texts(documents([]), PATH).count() == 0
