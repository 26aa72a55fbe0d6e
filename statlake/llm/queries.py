"""One query per operator, over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bytebpe, dualtree, idfiles, langid, lm, neardup_texts, neardup_vectors, packing, pairindex, repair, sharding, topk, toxicity
from .common import held_out, ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_extendible_shards(spark, sf):
    """The shard of every document, by a hash of its id."""
    docs = table(spark, sf, "documents").select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return sharding.assign_shards(docs, "doc_id", F.col("n_bytes"))


def op2_kneser_ney(spark, sf):
    """Log10 probability of all documents, learned from six of seven folds."""
    docs = table(spark, sf, "documents").select("doc_id", "text", held_out("doc_id", 7, 2).alias("held_out"))
    model = lm.train(docs.where(~F.col("held_out")), order=3)
    return lm.score_texts(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op3_byte_bpe(spark, sf):
    """Ids of all documents under the multilingual ranks, and their decoding."""
    return bytebpe.encode_texts(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN)


def op4_language_id(spark, sf):
    """Language of all documents, learned from four of five folds."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", held_out("doc_id", 5, 0).alias("held_out"))
    rows = langid.learn_profiles(docs.where(~F.col("held_out"))).collect()
    return (langid.identify(docs.select("doc_id", "held_out", "text"), langid.Profiles(rows))
            .select("doc_id", "held_out", "lang_pred", "score"))


def op5_near_vectors(spark, sf):
    """Links and components of all vectors at a cosine of 0.95 or more."""
    return neardup_vectors.near_duplicates(table(spark, sf, "embeddings"))


def op6_pack_sequences(spark, sf):
    """Pieces of all documents in sequences of 4096 ids."""
    pieces = packing.token_pieces(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return packing.pack(pieces)


def op7_id_files(spark, sf):
    """Ids of all documents, written as byte planes and read back."""
    return idfiles.round_trip(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op8_order_minhash(spark, sf):
    """The class of near copies of every document."""
    return neardup_texts.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


def op9_toxicity(spark, sf):
    """Toxicity of all documents, learned from the labels of four of five folds."""
    docs = table(spark, sf, "documents").select("doc_id", "text", held_out("doc_id", 5, 0).alias("held_out"))
    grammar = toxicity.learn(toxicity.labelled_sample(docs.where(~F.col("held_out")), table(spark, sf, "labels")))
    return (toxicity.score_texts(docs.select("doc_id", "held_out", "text"), grammar)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op10_top_k(spark, sf):
    """The 20 rows with the highest inner products for every twentieth vector, against all others."""
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_dual_tree_search(spark, sf):
    """The 50 highest-scoring documents of every benchmark item."""
    return dualtree.rank(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_pair_index_bpe(spark, sf):
    """Ids of all documents under the word file, by the pair index, and their decoding."""
    return pairindex.encode_texts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_conversation_repair(spark, sf):
    """Faults and cheapest repair of all damaged conversations."""
    return repair.repair_damaged(table(spark, sf, "conversations"))


_REGISTERED = (op1_extendible_shards, op2_kneser_ney, op3_byte_bpe, op4_language_id, op5_near_vectors, op6_pack_sequences, op7_id_files,
               op8_order_minhash, op9_toxicity, op10_top_k, op11_dual_tree_search, op12_pair_index_bpe, op13_conversation_repair)


def shipped(fn):
    """The query, with this package sent to the executors first."""
    @functools.wraps(fn)
    def run(spark, *args):
        ship(spark)
        return fn(spark, *args)
    return run


def queries() -> dict[str, Query]:
    return {fn.__name__: shipped(fn) for fn in _REGISTERED}


def oracle_sql() -> dict[str, str]:
    return {"op1_extendible_shards": sharding.ORACLE, "op10_top_k": topk.ORACLE, "op11_dual_tree_search": dualtree.ORACLE}
