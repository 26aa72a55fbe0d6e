"""The corpus pipeline: toxicity, language, near copies, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it kept, and returns the columns of
``documents``, but for the last, which returns the packed pieces.  What a stage learns it learns from its own
input and, for toxicity, from the table of labels.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from statlake.llm import langid, neardup_texts, packing, toxicity
from statlake.llm.common import free_name, held_out, ship, table
from statlake.plans.lineage import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the grammar scores below 0.5 stay; it learns from four of five folds, as in its own query."""
    ship(spark)
    learning = docs.where(~held_out("doc_id", 5, 0))
    grammar = toxicity.learn(toxicity.labelled_sample(learning, table(spark, sf_dir, "labels")))
    score = free_name(docs.columns, "toxicity")
    return toxicity.score_texts(docs, grammar, column=score).where(F.col(score) < 0.5).select(docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a known language stay: they hold letters, and n-grams of a learned profile."""
    ship(spark)
    learning = docs.where(~held_out("doc_id", 5, 0))
    profiles = langid.Profiles(langid.learn_profiles(learning).collect())
    language, score = free_name(docs.columns, "language"), free_name(docs.columns, "nearness")
    found = langid.identify(docs, profiles, lang_column=language, score_column=score)
    return found.where((F.col(language) != langid.UNKNOWN) & (F.col(score) > 0)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    ship(spark)
    return neardup_texts.without_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids."""
    ship(spark)
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), 2))


STAGES = [("toxicity", drop_toxic), ("language_id", keep_languages), ("near_dedup", drop_near_copies),
          ("packing", pack_sequences)]

# SQL can state none of it: two stages learn a model, one aligns texts, one runs a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
