import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from statlake.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture()
def documents(spark):
    """Documents with nulls, empty, long, repeated and clashing columns."""
    def make(rows, extra=False):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        if extra:
            for name in ("score", "start", "length", "n_tokens", "key", "digest", "cid", "class_id", "sequence_id", "offset"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make

