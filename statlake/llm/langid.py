"""Language identification by rank-order profiles of character n-grams.

A profile is the ``PROFILE`` most frequent n-grams (one to three letters inside a word, a blank at
its ends) of all training texts in a language, in order of frequency.  A document gets a profile
in the same way; its out-of-place distance to a language adds up, over its n-grams, how far the two
ranks differ, and ``PROFILE`` for an n-gram the language's profile lacks.  The nearest language wins.

N-grams are counted from whole texts, summed inside tasks first and by Spark after that.  Only the finished profiles
reach the driver: ``PROFILE`` rows for each language.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is everything when nothing
can be learned; equal frequencies rank by code points; equal distances go to the smaller language name; texts in any
case are compared in lower case; a row with a null id is never held out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import texts_of

PROFILE = 300
UNKNOWN = "und"
_COUNTED_AT_ONCE = 1 << 21  # n-grams gathered before they are sorted and summed

_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(text: str) -> np.ndarray:
    """Codes of the n-grams of a text, with repeats: up to three code points of 21 bits each."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points = np.where(_is_letter()[points], points, 32)
    blank = points == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # of a run of blanks only the first
    keep[0] = True
    points = points[keep]
    if len(points) < 2:
        return np.empty(0, np.int64)
    blank = points == 32
    two = points[:-1] << 21 | points[1:]
    three = points[:-2] << 42 | two[1:]
    return np.concatenate([points[~blank], two, three[~blank[1:-1]]])


def counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and how often (or with what weight) each occurs."""
    if weights is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    totals = np.diff(np.r_[first, len(codes)]) if weights is None else np.add.reduceat(weights, first) if len(first) else weights
    return codes[first], totals


def ranked(text: str, size: int = PROFILE) -> np.ndarray:
    """The text's profile: its most frequent n-grams, most frequent first."""
    codes, totals = counted(grams(text))
    return codes[np.argsort(-totals, kind="stable")[:size]]


class _Sums:
    """Counts of one language inside one task, summed whenever enough have come."""

    def __init__(self):
        self.codes, self.totals = np.empty(0, np.int64), np.empty(0, np.int64)
        self.new, self.held = [], 0

    def add(self, codes: np.ndarray) -> None:
        self.new.append(codes)
        self.held += len(codes)
        if self.held >= _COUNTED_AT_ONCE:
            self.settle()

    def settle(self) -> None:
        if self.new:
            codes, totals = counted(np.concatenate(self.new))
            self.codes, self.totals = counted(np.concatenate([self.codes, codes]), np.concatenate([self.totals, totals]))
            self.new, self.held = [], 0


def learn_profiles(labelled: DataFrame, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """One row per language and rank: ``lang``, ``gram``, ``place`` (from 0)."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()),
                           T.StructField("n", T.LongType())])

    def count(batches):
        sums: dict[str, _Sums] = {}
        for batch in batches:
            for t, language in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                sums.setdefault(language, _Sums()).add(grams(t))
        for language, s in sums.items():
            s.settle()
            for at in range(0, len(s.codes), 1 << 16):
                codes = s.codes[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(s.totals[at:at + (1 << 16)])],
                    names=schema.names)

    totals = (labelled.where(F.col(lang).isNotNull()).select(text, F.col(lang).cast("string")).mapInArrow(count, schema)
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # The best of each share first, so that no task sees all n-grams of a common language.
    best = Window.partitionBy("lang", "share").orderBy(F.desc("n"), "gram")
    within = (totals.withColumn("share", F.pmod(F.xxhash64("gram"), F.lit(32)))
              .withColumn("place", F.row_number().over(best)).where(F.col("place") <= size))
    overall = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return (within.withColumn("place", F.row_number().over(overall) - 1).where(F.col("place") < size)
            .select("lang", "gram", "place"))


class Profiles:
    """All languages' ranks of the n-grams that any of them has."""

    def __init__(self, rows, size: int = PROFILE):
        self.size = size
        self.langs = sorted({r["lang"] for r in rows})
        self.codes = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int64)
        for r in rows:
            self.ranks[np.searchsorted(self.codes, r["gram"]), self.langs.index(r["lang"])] = r["place"]

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, and how near: 1 for the same ranks, 0 for no n-gram in common."""
        mine = ranked(text, self.size)
        if not len(mine) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, mine), len(self.codes) - 1)
        theirs = np.where((self.codes[at] == mine)[:, None], self.ranks[at], -1)
        apart = np.minimum(np.abs(theirs - np.arange(len(mine))[:, None]), self.size)
        distance = np.where(theirs < 0, self.size, apart).sum(0)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.size * len(mine)))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", lang_column: str = "lang_pred",
             score_column: str = "score") -> DataFrame:
    """All rows and columns with the predicted language and its score; columns of these names are replaced."""
    docs = docs.drop(lang_column, score_column)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_column, T.StringType()),
                           T.StructField(score_column, T.DoubleType())])
    place = docs.columns.index(text)

    def predict(batches):
        for batch in batches:
            found = [profiles.predict(t) for t in texts_of(batch.column(place))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=schema.names)

    return docs.mapInArrow(predict, schema)
