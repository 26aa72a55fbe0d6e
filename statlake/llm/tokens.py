"""Ids of texts under public tokenizer files, with repeated words encoded once.

``WordBpe`` reads a file of the ``tokenizers`` library.  In a file whose tokens mark the end of
a word and whose normaliser folds white space, no token spans a blank, so a text is cut at blanks
and line feeds and each different word is encoded once per worker.  Any other file is given whole
texts.  Special tokens written out in a text become their single ids, as in the library.  The words kept
per worker are bounded: a word met again moves to the young half, and when that is full the old half is
dropped, so frequent words stay.  Ids never depend on what is kept.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from itertools import chain, compress, repeat

import numpy as np

KEPT_WORDS = 250_000  # per half, and as many pieces

_SPACE = re.compile(r"\s")
_ASCII_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f"


def _keeps_words(normaliser: dict | None) -> bool:
    """Whether words without white space come out of it one for one, also when joined by blanks."""
    steps = (normaliser or {}).get("normalizers") or [normaliser or {}]
    return all(x.get("type") in ("NFC", "Lowercase")
               or x.get("type") == "Replace" and x.get("pattern") == {"Regex": "\\s+"} and x.get("content") == " " for x in steps)


@functools.cache
def _newer_letters() -> re.Pattern:
    """Characters that Unicode 3.2 does not know: two libraries can differ on whether they are letters."""
    category, ranges, first = unicodedata.ucd_3_2_0.category, [], None
    for code in range(0x110001):
        if code < 0x110000 and category(chr(code)) == "Cn":
            first = code if first is None else first
        elif first is not None:
            ranges.append(f"{chr(first)}-{chr(code - 1)}")
            first = None
    return re.compile("[" + "".join(ranges) + "]")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level files write for each byte: itself if printable in Latin-1, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + at) for at, b in enumerate(hidden)}


def word_pattern(spec: dict) -> str | None:
    """The pattern whose matches are encoded apart, for files of byte-level words that carry an end mark; else none."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if (len(steps) == 2 and steps[0].get("type") == "Split" and steps[0].get("invert") and steps[0].get("behavior") == "Removed"
            and "Regex" in steps[0].get("pattern", {}) and steps[1].get("type") == "ByteLevel"
            and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex", True)
            and spec["model"].get("end_of_word_suffix") and not spec["model"].get("unk_token")):
        return steps[0]["pattern"]["Regex"]
    return None


def special_tokens(spec: dict) -> dict[str, int] | None:
    """Added tokens and their ids; none if the library looks for one of them in another way than as it stands."""
    added = spec.get("added_tokens") or []
    plain = all(not (t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized")) for t in added)
    return {t["content"]: t["id"] for t in added} if plain else None


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, word):
        self[word] = number = len(self)
        self.new.append(word)
        return number


class _Runs:
    """Ragged integer rows in two flat arrays, appended to and gathered by row number."""

    def __init__(self):
        self.values, self.ends = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64)
        self.rows = 0

    def append(self, values: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self.ends[self.rows])
        while used + len(values) > len(self.values):
            self.values = np.concatenate([self.values, np.empty_like(self.values)])
        while self.rows + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.values[used:used + len(values)] = values
        self.ends[self.rows + 1:self.rows + 1 + len(lengths)] = used + np.cumsum(lengths)
        self.rows += len(lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the given rows in a row, and the length of each."""
        first = self.ends[rows]
        lengths = self.ends[rows + 1] - first
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        return self.values[np.repeat(first - before, lengths) + np.arange(total)], lengths


class _Kept:
    """Numbered words and the ids of each."""

    def __init__(self):
        self.numbers, self.ids = _Numbers(), _Runs()


class WordBpe:
    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spec = spec = json.loads(self.tokenizer.to_str())
        self.joins = _keeps_words(spec.get("normalizer"))
        self.lowers = '"Lowercase"' in json.dumps(spec.get("normalizer"))
        pattern, self.special = word_pattern(spec), special_tokens(spec)
        self.pattern = None
        if pattern and self.special is not None:
            self.pattern = regex.compile(pattern)
            self.pattern_or_blank = regex.compile(f"(?:{pattern})| ")
            self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
            self.special_start = os.path.commonprefix(list(self.special))
            self.letters = byte_letters() | {ord("\n"): "\n"}
            self.bytes_of = {ord(letter): b for b, letter in byte_letters().items()}
        self.kept = kept
        self.words, self.old, self.pieces = _Kept(), _Kept(), _Kept()

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        rows = [np.asarray(e.ids, np.int32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate(rows) if rows else np.empty(0, np.int32), np.array([len(r) for r in rows], np.int64)

    def _normalised(self, words: list[str]) -> list[str]:
        """Each word as the normaliser leaves it.  Of the steps that keep words, only the one to lower case reaches ASCII without white space."""
        if not self.tokenizer.normalizer:
            return words
        if not self.joins:
            return list(map(self.tokenizer.normalizer.normalize_str, words))
        plain = list(map(str.isascii, words))
        together = " ".join(compress(words, plain))
        if any(space in together for space in _ASCII_SPACES):
            plain = [ascii and not _SPACE.search(w) for w, ascii in zip(words, plain)]
            together = " ".join(compress(words, plain))
        lowered = iter((together.lower() if self.lowers else together).split(" "))
        others = iter(self._normalised_joined([w for w, is_plain in zip(words, plain) if not is_plain]))
        return [next(lowered) if is_plain else next(others) for is_plain in plain]

    def _normalised_joined(self, words: list[str]) -> list[str]:
        """Only words without white space are joined, as any other may add or lose blanks."""
        alone = self.tokenizer.normalizer.normalize_str
        plain = [w for w in words if not _SPACE.search(w)] if _SPACE.search("".join(words)) else words
        split = alone(" ".join(plain)).split(" ") if plain else []
        if len(split) != len(plain):  # the normaliser moved a blank: one word at a time
            return list(map(alone, words))
        if plain is words:
            return split
        rest = iter(split)
        return [alone(w) if _SPACE.search(w) else next(rest) for w in words]

    def piece_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces in a row, and how many each has."""
        letters = "\n".join(pieces).encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters).split("\n")
        ids, sizes = [], []
        for tokens in map(self.tokenizer.model.tokenize, letters):  # no list of each is kept: many would set off the garbage collector
            ids += [t.id for t in tokens]
            sizes.append(len(tokens))
        return np.array(ids, np.int32), np.array(sizes, np.int64)

    def _cut(self, word: str) -> list[str]:
        """The pieces of a word; the library is asked where its own tables decide."""
        if _newer_letters().search(word):
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(word)
            return [letters.translate(self.bytes_of).encode("latin-1").decode("utf-8", "surrogatepass") for letters, _ in found]
        return self.pattern.findall(word)

    def _pieces_of(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and how many stand before each blank and at the end."""
        if len(self.pieces.numbers) > self.kept or not self.pieces.ids.rows:
            self.pieces = _Kept()
            self.pieces.numbers[" "]
            self.pieces.numbers.new = []
            self.pieces.ids.append(np.empty(0, np.int32), np.zeros(1, np.int64))
        numbers = np.fromiter(map(self.pieces.numbers.__getitem__, found), np.int64, len(found))
        new, self.pieces.numbers.new = self.pieces.numbers.new, []
        if new:
            self.pieces.ids.append(*self.piece_ids(new))
        ids, sizes = self.pieces.ids.take(numbers)
        ends = np.append(np.cumsum(sizes)[numbers == 0], len(ids))
        return ids, np.diff(ends, prepend=0)

    def _learn(self, words: list) -> None:
        """Take over what the old half knows of words new to the young one, and encode the rest."""
        places = np.fromiter(map(self.old.numbers.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(places < 0).tolist()
        new = [words[at] for at in unknown]
        marks = {at for at, w in zip(unknown, new) if not isinstance(w, str)} if self.special else set()
        split = self._normalised([w if isinstance(w, str) else "" for w in new] if marks else new)
        together = " ".join(split)
        newer = _newer_letters().search  # finds nothing in ASCII
        alone = marks
        if newer(" ".join(w for w in split if not w.isascii())):
            alone |= {at for at, w in zip(unknown, split) if not w.isascii() and newer(w)}
        if together.count(" ") >= len(split):
            alone |= {at for at, w in zip(unknown, split) if " " in w}
        if alone:
            together = " ".join(w for at, w in zip(unknown, split) if at not in alone)
        ids, sizes = (self._pieces_of(self.pattern_or_blank.findall(together)) if len(alone) < len(unknown)
                      else (np.empty(0, np.int32), np.empty(0, np.int64)))
        joined = _Runs()
        joined.append(*self.old.ids.take(places[places >= 0]))
        joined.append(ids, sizes)
        order = np.zeros(len(words), np.int64)
        order[places >= 0] = np.arange(int((places >= 0).sum()))
        rows = joined.rows - len(sizes)
        if not alone:
            order[unknown] = rows + np.arange(len(unknown))
        for at, word in zip(unknown, split) if alone else ():
            if at in alone:  # a special token, or a word with white space or newer letters inside
                own = [words[at]] if isinstance(words[at], int) else self._pieces_of(self._cut(word))[0]
                order[at] = joined.rows
                joined.append(np.asarray(own, np.int32), np.array([len(own)]))
            else:
                order[at] = rows
                rows += 1
        self.words.ids.append(*joined.take(order))

    def _split(self, text: str) -> list:
        """Words of a text, and the ids of special tokens in between."""
        if not self.special or self.special_start not in text:
            return text.replace("\n", " ").split(" ")
        out = []
        for at, part in enumerate(self.special_pattern.split(text)):
            if at % 2:
                out.append(self.special[part])
            else:
                out.extend(part.replace("\n", " ").split(" "))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (int32), and how many each text has."""
        if self.pattern is None:
            return self._whole(texts)
        if len(self.words.numbers) > self.kept:
            self.words, self.old = _Kept(), self.words
        split = list(map(self._split, texts))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self.words.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        new, self.words.numbers.new = self.words.numbers.new, []
        if new:
            self._learn(new)
        ids, sizes = self.words.ids.take(numbers)
        return ids, _sums(sizes, counts)

    def encode_long(self, text: str, most: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode`` of one text, holding the words of about ``most`` characters at a time."""
        if self.pattern is None or len(text) <= most:
            return self.encode([text])
        parts, at = [], 0
        while at < len(text):
            end = text.find(" ", at + most)  # no token spans a blank
            end = len(text) if end < 0 else end
            parts.append(self.encode([text[at:end]])[0])
            at = end + 1
        ids = np.concatenate(parts)
        return ids, np.array([len(ids)])


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of values."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


_workers: dict = {}


def word_bpe(path: str, kept: int = KEPT_WORDS) -> WordBpe:
    """One encoder per worker process, file and number of kept words."""
    if (path, kept) not in _workers:
        _workers[path, kept] = WordBpe(path, kept)
    return _workers[path, kept]
