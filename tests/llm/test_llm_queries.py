"""The registered queries and the pipeline on the smallest tables."""

import os
import zlib

import pytest

import corpus_pipeline
from oracle import compare, duck
from statlake.llm import neardup_texts, queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_all_are_registered():
    import __spark_entry__ as contract
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    verdict, _ = compare(spark, duck(SF), SF, name, queries.queries()[name], queries.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_a_row_for_every_row(spark, name):
    got = queries.queries()[name](spark, SF).toPandas()
    table, key = next((t, k) for t, k in (("embeddings", "vec_id"), ("conversations", "conv_id"), ("documents", "doc_id")) if k in got)
    ids = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()]
    ids = ids if table != "conversations" else sorted(set(ids))
    assert sorted(set(got[key])) == sorted(ids)
    if not name.startswith("op6"):
        assert len(got) == len(ids)
    if "held_out" in got:
        modulus, rest = (7, 2) if name.startswith("op2") else (5, 0)
        assert all(h == (zlib.crc32(str(i).encode()) % modulus == rest) for i, h in zip(got[key], got["held_out"]))
    if "score" in got and not name.startswith("op2"):
        assert got["score"].between(0, 1).all()


def test_the_model_beats_the_base_on_texts_held_out(spark):
    got = queries.queries()["op2_kneser_ney"](spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


def test_language_and_toxicity_on_texts_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = queries.queries()["op4_language_id"](spark, sf).where("held_out").join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    assert (lang["lang"] == lang["lang_pred"]).mean() > 0.97
    toxic = queries.queries()["op9_toxicity"](spark, sf).where("held_out").join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (toxic["toxic"] == toxic["predicted"]).mean() > 0.95


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    kept = {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(at)))
        docs = spark.read.parquet(str(tmp_path / str(at)))
        kept[name] = docs
    for name in ("toxicity", "language_id", "near_dedup"):
        assert kept[name].columns == columns
    ids = lambda name: {r[0] for r in kept[name].select("doc_id").collect()}
    assert ids("near_dedup") < ids("language_id") <= ids("toxicity") and len(ids("toxicity")) < before
    texts = {r.doc_id: neardup_texts.shingles(r.text) for r in kept["near_dedup"].collect()}
    some = sorted(texts)
    assert not any(neardup_texts.similar(texts[a], texts[b]) for a in some for b in some if a < b)
    assert ids("packing") == ids("near_dedup")
    whole = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert whole == sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in kept["packing"].collect())


def test_the_entry_does_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "statlake"), tmp_path / "statlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert done.returncode == 0 and done.stdout.split()[0] == done.stdout.split()[1], done.stderr


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_stages_take_awkward_documents(spark, rows):
    from llm_rows import ROWS
    docs = spark.createDataFrame([(i, t, x, None, None) for i, t, x in ROWS] if rows == "awkward" else [],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "'x' AS toxicity", "1 AS language", "2 AS own_cid", "3 AS sequence_id")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "toxicity", "language", "own_cid", "sequence_id"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    # Texts without a letter go, of the two equal rows one stays.
    assert sorted({r.doc_id or 0 for r in packed}) == ([0, 1, 4, 5, 6, 8] if rows == "awkward" else [])
    assert sum(r.doc_id == 5 and r.start == 0 for r in packed) == (1 if rows == "awkward" else 0)
