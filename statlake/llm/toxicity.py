"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text is cut into clauses, and each clause becomes a string of symbols: a lexical transducer turns words into
insults ``I``, likely insults ``W``, threat verbs ``V``, targets ``T``, negations ``N``, reporting verbs ``R``, words for words ``M`` and
others ``o``.  Further transducers are composed after it: reported speech rewrites what follows a reporting verb in its
clause, mention what follows a word for a word, negation what follows a negation within ``REACH`` words, target what is
aimed at somebody, threat a verb with its target, and carrier an insult that stands in its clause without any other word (bare, or called out if
the clause before holds other words).  What leaves the
last one are matched clauses of a few kinds, each clause once per kind, and a kind has a weight: the learned share of toxic texts
among those that hold it.  Clauses with a likely insult, which clean texts hold now and then, are weighed by their number and by their
share of all clauses.  A text's score is the chance that at least one match makes it toxic.

An insult word by itself matches nothing that decides: bare, mentioned, reported and negated insults have weights under 0.5 whatever is
learned, however often they come, and so has a single clause with a likely insult.  An insult that a clause of other words carries is a
match also without a target, since texts in which that alone marks toxicity are common.

Insults are learned from labelled texts: whole words, and stems that take many endings.  Evidence is the
number of different words that stand before a word, so that many copies of one text count as little as one.  Only a
sample of at most ``TOXIC_ROWS`` toxic and ``OTHER_ROWS`` other labelled texts is read for that, chosen by a hash
of the id; the sample alone has a bound, every text is scored whole.

Defined results: a null or empty text has no match and gets the base score; of several labels of one document
the toxic one counts, of several texts of one document the first in order is learned from; null labels are not learned from; without labels no insult is known and every score is the
base score; equal rows score equally; an empty table gives no rows; columns of other names stay.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import texts_of

TOXIC_ROWS = 4_000
OTHER_ROWS = 8_000
SHORTEST_STEM, LONGEST_STEM = 3, 7
PURE = 0.98  # share of a word's evidence from toxic texts that makes it an insult wherever it stands
LIKELY = 0.6  # share that makes it a likely insult, which counts by how often it comes
REACH = 3  # words over which a negation or a threat reaches
KEPT_WORDS = 100_000

# Function words of the grammar in four languages.
NEGATIONS = "not no never isn't aren't wasn't don't doesn't ne pas jamais nicht kein keine nie nunca jamás ni".split()
TARGETS = "you your you're u yourself du dich dir ihr euch sie tu toi te vous ton tú ti usted ustedes".split()
REPORTS = "said says say called calls wrote claimed quoted told sagte sagt schrieb dit disait écrit appelle dijo dice llamó".split()
MENTIONS = "word words term terms spelling wort worte wörter begriff mot mots terme palabra palabras término".split()
THREATS = "kill hurt destroy beat stab shoot burn töten umbringen verletzen tuer frapper brûler matar golpear quemar".split()

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n|\"“”«»()]+")

# Shares of toxic texts expected of a kind of match before any is seen, and how many texts that is worth.
CALLED = "called insult"  # a bare one right after a clause of other words
PRIOR = {"insult": 0.9, "aimed insult": 0.95, CALLED: 0.7, "negated insult": 0.3, "reported insult": 0.3, "mentioned insult": 0.2, "bare insult": 0.3,
         "aimed likely insult": 0.6, "negated likely insult": 0.05,
         "threat": 0.9, "negated threat": 0.3, "reported threat": 0.3, "": 0.05}
PRIOR |= {f"likely insult {many}-{dense}": prior for many, row in
          {1: (0.1, 0.15, 0.3), 2: (0.2, 0.5, 0.7), 3: (0.3, 0.7, 0.9), 4: (0.3, 0.8, 0.95)}.items()
          for dense, prior in enumerate(row)}
# Kinds that never decide, not even together: all their matches weigh as one, of at most this.
MOST_ALONE = 0.45
WEAK = ("negated insult", "reported insult", "mentioned insult", "bare insult", "negated likely insult", "negated threat", "reported threat",
        "likely insult 1-0", "likely insult 1-1", "likely insult 1-2")
PRIOR_TEXTS = 2.0
FEW, MANY = 0.04, 0.12  # shares of clauses with a likely insult
KINDS = {"I": "insult", "J": "aimed insult", "i": "negated insult", "q": "reported insult", "m": "mentioned insult", "b": "bare insult",
         "W": "likely insult", "U": "aimed likely insult", "w": "negated likely insult", "H": "threat", "h": "negated threat", "r": "reported threat"}


class Transducer:
    """States, and for a state and a symbol the next state and what is written instead of the symbol."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def __call__(self, symbols: str) -> str:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.arcs.get((state, symbol)) or self.arcs.get((state, None), (state, None))
            out.append(written or symbol)
        return "".join(out)


def _reported() -> Transducer:
    """After a reporting verb, to the end of its clause."""
    return Transducer("plain", {("plain", "R"): ("told", None), ("told", "|"): ("plain", None),
                                ("told", "I"): ("told", "q"), ("told", "W"): ("told", "q"), ("told", "V"): ("told", "r"), ("told", None): ("told", None)})


def _negated() -> Transducer:
    """Within ``REACH`` words after a negation, in one clause."""
    arcs = {(0, "N"): (REACH, None)}
    for left in range(1, REACH + 1):
        arcs |= {(left, None): (left - 1, None), (left, "N"): (REACH, None), (left, "|"): (0, None),
                 (left, "I"): (left - 1, "i"), (left, "W"): (left - 1, "w"), (left, "V"): (left - 1, "v")}
    return Transducer(0, arcs)


def _mentioned() -> Transducer:
    """Within ``REACH`` words after a word for a word, in one clause."""
    arcs = {(0, "M"): (REACH, None)}
    for left in range(1, REACH + 1):
        arcs |= {(left, None): (left - 1, None), (left, "M"): (REACH, None), (left, "|"): (0, None),
                 (left, "I"): (left - 1, "m"), (left, "W"): (left - 1, "m")}
    return Transducer(0, arcs)


def _uncarried() -> Transducer:
    """Insults with nothing but insults before them in their clause."""
    return Transducer("bare", {("bare", "I"): ("bare", "b"), ("bare", "W"): ("bare", "c"), ("bare", None): ("carried", None),
                               ("carried", "|"): ("bare", None), ("carried", None): ("carried", None), ("bare", "|"): ("bare", None)})


def _carried() -> Transducer:
    """Read from the end of a clause: insults that have another word behind them are carried after all."""
    return Transducer("bare", {("bare", "b"): ("bare", None), ("bare", "c"): ("bare", "o"), ("bare", None): ("carried", None),
                               ("carried", "b"): ("carried", "I"), ("carried", "c"): ("carried", "W"), ("carried", None): ("carried", None),
                               ("carried", "|"): ("bare", None), ("bare", "|"): ("bare", None)})


def _aimed() -> Transducer:
    """An insult in a clause that has named its target before."""
    return Transducer("open", {("open", "T"): ("aimed", None), ("aimed", "|"): ("open", None),
                               ("aimed", "I"): ("aimed", "J"), ("aimed", "W"): ("aimed", "U"), ("aimed", None): ("aimed", None)})


def _threat() -> Transducer:
    """A threat verb and its target within ``REACH`` words: the target is written as the match."""
    arcs = {(0, verb): ((verb, REACH), "o") for verb in "Vvr"}
    for verb, match in (("V", "H"), ("v", "h"), ("r", "r")):
        for left in range(1, REACH + 1):
            after = (verb, left - 1) if left > 1 else 0
            arcs |= {((verb, left), None): (after, None), ((verb, left), "|"): (0, None), ((verb, left), "T"): (0, match)}
            arcs |= {((verb, left), again): ((again, REACH), "o") for again in "Vvr"}
    return Transducer(0, arcs)


class _Symbols(dict):
    def __init__(self, words: frozenset, stems: tuple, likely_words: frozenset, likely_stems: tuple):
        self.words, self.stems, self.likely_words, self.likely_stems = words, stems, likely_words, likely_stems
        self.fixed = {w: s for s, ws in (("V", THREATS), ("R", REPORTS), ("T", TARGETS), ("N", NEGATIONS), ("M", MENTIONS)) for w in ws}

    def __missing__(self, token: str) -> str:
        word = token.lower().replace("’", "'")
        if not (word[0].isalpha()):
            symbol = "|"
        elif word in self.words or word.startswith(self.stems):
            symbol = "I"
        elif word in self.likely_words or word.startswith(self.likely_stems):
            symbol = "W"
        else:
            symbol = self.fixed.get(word, "o")
        if len(self) > KEPT_WORDS:
            self.clear()
        self[token] = symbol
        return symbol


class Lexicon(NamedTuple):
    words: list[str]
    stems: list[str]
    likely_words: list[str]
    likely_stems: list[str]


class Grammar:
    """The composed transducers and the weight of each kind of match."""

    def __init__(self, lexicon: Lexicon, weights: dict[str, float] | None = None):
        self.lexicon, self.weights = lexicon, weights or dict(PRIOR)
        self.chain = [_reported(), _mentioned(), _negated(), _aimed(), _threat(), _uncarried()]
        self.backward = _carried()
        self._symbols = None

    def __getstate__(self):
        return self.__dict__ | {"_symbols": None}

    def matches(self, text: str) -> dict[str, int]:
        """How many clauses match each kind; those with a likely insult count as one match of the kind their number and share make."""
        if self._symbols is None:
            words, stems, likely_words, likely_stems = self.lexicon
            self._symbols = _Symbols(frozenset(words), tuple(stems), frozenset(likely_words), tuple(likely_stems))
        symbols = "".join(map(self._symbols.__getitem__, _TOKEN.findall(text)))
        found: dict[str, int] = {}
        clauses = [c for c in symbols.split("|") if c]
        spoken = False  # whether the clause before holds more than insults
        for clause in clauses:
            if "I" in clause or "V" in clause or "W" in clause:
                for kind in self.kinds(clause):
                    kind = CALLED if kind == "bare insult" and spoken else kind
                    found[kind] = found.get(kind, 0) + 1
            spoken = bool(clause.strip("IW"))
        likely = found.pop("likely insult", 0)
        if likely:
            share = likely / len(clauses)
            found[f"likely insult {min(likely, 4)}-{(share >= FEW) + (share >= MANY)}"] = 1
        return found

    def kinds(self, clause: str) -> set[str]:
        """The kinds of match in one clause."""
        for transducer in self.chain:
            clause = transducer(clause)
        return {KINDS[symbol] for symbol in set(self.backward(clause[::-1])) & KINDS.keys()}

    def score(self, text: str) -> float:
        clean, weak = 1.0, 0.0
        for kind, count in self.matches(text).items():
            if kind in WEAK:
                weak = max(weak, self.weights[kind])
            else:
                clean *= (1 - self.weights[kind]) ** count
        return 1 - clean * (1 - max(self.weights[""], min(weak, MOST_ALONE)))


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS,
                    other_rows: int = OTHER_ROWS) -> DataFrame:
    """``text, toxic, weight`` of at most that many labelled documents of each kind (one in a thousand more by chance)."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {kind: min(1.0, bound / max(1, counts.get(kind, 0))) for kind, bound in ((True, toxic_rows), (False, other_rows))}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    drawn = F.when(F.col("toxic"), F.lit(share[True])).otherwise(F.lit(share[False]))
    few = known.where(draw < drawn).withColumn("weight", 1 / drawn)
    # At most some ten thousand rows of two short columns, whatever the size of the tables.
    return (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).join(F.broadcast(few), "doc_id")
            .groupBy("doc_id", "toxic", "weight").agg(F.min("text").alias("text")).select("text", "toxic", "weight"))


def learn(sample: DataFrame) -> Grammar:
    """Insults and weights from ``text, toxic, weight`` rows; a bounded sample."""
    sample = sample.persist()
    try:
        return _weighted(sample, _insults(sample))
    finally:
        sample.unpersist()


def _insults(sample: DataFrame) -> Lexicon:
    schema = "word string, before string, toxic boolean, weight double"

    def words(batches):
        for batch in batches:
            seen = set()
            for text, toxic, weight in zip(texts_of(batch.column(0)), *(batch.column(i).to_pylist() for i in (1, 2))):
                found = [w.lower() for w in _TOKEN.findall(text) if w[0].isalpha()]
                seen.update(zip(found, ["", *found], [toxic] * len(found), [weight] * len(found)))
            columns = list(zip(*seen)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.string(), pa.bool_(), pa.float64()))], names=["word", "before", "toxic", "weight"])

    def summed(column, toxic):
        return F.sum(F.when(F.col("toxic") == toxic, column).otherwise(F.lit(0.0)))

    counts = (sample.select("text", "toxic", "weight").mapInArrow(words, schema).distinct().groupBy("word")
              .agg(summed(F.lit(1.0), True).alias("pos"), summed(F.lit(1.0), False).alias("neg"),
                   summed(F.col("weight"), True).alias("all_pos"), summed(F.col("weight"), False).alias("all_neg")))
    evidence = ["pos", "neg", "all_pos", "all_neg"]
    counts = counts.persist()
    try:
        totals = counts.agg(*(F.sum(c).alias(c) for c in evidence), F.count(F.lit(1)).alias("n")).first()
        if not totals["pos"] or not totals["neg"]:
            return Lexicon([], [], [], [])
        base, least = totals["pos"] / (totals["pos"] + totals["neg"]), math.log(max(2, totals["n"]))
        drawn, pure = F.col("pos") / (F.col("pos") + F.col("neg")), F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))
        # How unlikely so pure a word is by chance, against the number of words that were looked at.
        surprise = (F.when(F.col("pos") > 0, F.col("pos") * F.log(drawn / base)).otherwise(0.0)
                    + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - drawn) / (1 - base))).otherwise(0.0))
        telling = (pure >= LIKELY) & (drawn > base) & (surprise >= least)
        words_found = {r["word"]: r["pure"] for r in counts.where(telling).select("word", pure.alias("pure")).collect()}
        lengths = F.sequence(F.lit(SHORTEST_STEM), F.lit(LONGEST_STEM))
        stems = (counts.withColumn("length", F.explode(lengths)).where(F.length("word") > F.col("length"))
                 .groupBy(F.expr("left(word, length)").alias("stem"))
                 .agg(*(F.sum(c).alias(c) for c in evidence), F.count(F.lit(1)).alias("words"))
                 .where(telling & (F.col("words") >= 3)).select("stem", "pos", pure.alias("pure")).collect())
    finally:
        counts.unpersist()
    # Of stems with nearly the same evidence the longest says most exactly what was seen.
    kept = {r["stem"]: r["pure"] for r in stems
            if not any(o["stem"] != r["stem"] and o["stem"].startswith(r["stem"]) and o["pos"] >= 0.9 * r["pos"] for o in stems)}
    return Lexicon(*(sorted(k for k, share in found.items() if (share >= PURE) == sure)
                     for sure in (True, False) for found in (words_found, kept)))


def _weighted(sample: DataFrame, lexicon: Lexicon) -> Grammar:
    grammar = Grammar(lexicon)

    def kinds(batches):
        for batch in batches:
            rows = [(kind, toxic, weight)
                    for text, toxic, weight in zip(texts_of(batch.column(0)), *(batch.column(i).to_pylist() for i in (1, 2)))
                    for kind in (grammar.matches(text) or {"": 1})]
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.bool_(), pa.float64()))], names=["kind", "toxic", "weight"])

    seen = {r["kind"]: (r["pos"], r["n"], r["rows"]) for r in sample.select("text", "toxic", "weight")
            .mapInArrow(kinds, "kind string, toxic boolean, weight double").groupBy("kind")
            .agg(F.sum(F.when(F.col("toxic"), F.col("weight")).otherwise(0.0)).alias("pos"), F.sum("weight").alias("n"),
                 F.count(F.lit(1)).alias("rows")).collect()}
    weights = {}
    for kind, prior in PRIOR.items():
        pos, n, rows = seen.get(kind, (0.0, 0.0, 0))
        assumed = PRIOR_TEXTS * (n / rows if rows else 1.0)
        weights[kind] = (pos + assumed * prior) / (n + assumed)
        if kind in WEAK or not kind:
            weights[kind] = min(weights[kind], MOST_ALONE)
    return Grammar(lexicon, weights)


def score_texts(docs: DataFrame, grammar: Grammar, text: str = "text", column: str = "score") -> DataFrame:
    """All rows and columns with their score (0 to 1)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    place = docs.columns.index(text)

    def score(batches):
        for batch in batches:
            scores = [grammar.score(t) for t in texts_of(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return docs.mapInArrow(score, schema)
