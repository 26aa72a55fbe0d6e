"""Rows as they were at a sequence number, for many questions at once.

A question is a key and a sequence number; the answer is the key's last change up to it.  The sequence is cut into blocks of
``BLOCK`` numbers.  Inside a block a key has at most that many changes, which a window walks through together with the
questions; what a block passes on to later ones is one row per key, and a second window walks through those.  So a key with a
large share of the feed is spread over its blocks, and no window is longer than a block or the number of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..model import ChangeColumns
from ..plans.sizing import quoted
from .cdc import NAMES, check_feed

BLOCK = 1 << 20  # sequence numbers, not rows: a feed may have gaps


def rows_at(changes: DataFrame, questions: DataFrame, key: Sequence[str], *, at: str = "at", names: ChangeColumns = NAMES,
            block: int = BLOCK) -> DataFrame:
    """Each question with the columns of its key's row at that sequence number.

    ``questions`` has the key columns and ``at``; further columns of it stay.  The result adds ``_seq`` of the last change and the other columns of the
    feed's rows; all of them are null where the key was deleted or not there yet, or where ``at`` is null.  Null keys match null keys;
    a question asked twice is answered twice; changes without a sequence number are passed over.
    """
    check_feed(questions.schema, changes.schema, key, names)
    values = [c for c in changes.columns if c not in (*key, *names.all)]
    clash = {c.lower() for c in (*values, names.seq)} & {c.lower() for c in questions.columns}
    if clash:
        raise ValueError(f"questions and feed share the columns {sorted(clash)}")
    keys = [F.col(quoted(k)) for k in key]
    ks = [f"__k{i}" for i in range(len(key))]
    seq = F.col(quoted(names.seq))
    image = F.struct(seq.alias("seq"), F.col(quoted(names.op)).alias("op"), F.struct(*[F.col(quoted(v)) for v in values]).alias("row"))
    fed = (changes.filter(seq.isNotNull())
           .select(*[k.alias(a) for k, a in zip(keys, ks)], seq.cast("long").alias("__at"), image.alias("__image")))
    asked = questions.select(*[k.alias(a) for k, a in zip(keys, ks)], F.col(quoted(at)).cast("long").alias("__at"), F.struct("*").alias("__question"))
    number = F.floor(F.col("__at") / block).alias("__block")
    both = fed.unionByName(asked, allowMissingColumns=True).withColumn("__block", number)

    # A change comes before a question at its own number.
    inside = Window.partitionBy(*ks, "__block").orderBy("__at", F.col("__image").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    answered = both.withColumn("__last", F.last("__image", ignorenulls=True).over(inside)).filter(F.col("__question").isNotNull())

    # What each block leaves behind, and which blocks are asked about.
    left = both.groupBy(*ks, "__block").agg(F.max_by("__image", F.when(F.col("__image").isNotNull(), F.col("__at"))).alias("__left"),
                                            F.max(F.col("__question").isNotNull()).alias("__asked"))
    blocks = Window.partitionBy(*ks).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = left.withColumn("__before", F.last("__left", ignorenulls=True).over(blocks)).filter("__asked").drop("__left", "__asked")

    a, b = answered.alias("a"), before.alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*ks, "__block")])
    found = a.join(b, same, "left").select(F.col("a.__question").alias("question"), F.when(
        F.col("a.__at").isNotNull(), F.coalesce("a.__last", "b.__before")).alias("change"))
    alive = F.when(~F.col("change.op").eqNullSafe("D"), F.col("change"))
    return found.withColumn("change", alive).select("question.*", F.col("change.seq").alias(names.seq),
                                                    *[F.col(f"change.row.{quoted(v)}").alias(v) for v in values])
