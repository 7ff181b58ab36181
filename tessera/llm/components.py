"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WRITTEN, drop_written, written

SHARES = 32  # tasks that a hot key is dealt to
HOT_PART = 1024  # a key is hot if it holds more than this part of the rows, so there are fewer hot keys than this
HOT_ROWS = 64  # and at least so many rows


def hot_keys(rows: DataFrame, key: str) -> list[int]:
    """The keys (longs) that hold more than one ``HOT_PART``-th of the rows; fewer than ``HOT_PART``, counted map-side first."""
    least = max(HOT_ROWS, rows.count() // HOT_PART)
    return [r[0] for r in rows.groupBy(key).count().where(F.col("count") > least).select(key).collect()]


def spread_join(rows: DataFrame, key: str, other: DataFrame, other_key: str, salt: str, how: str = "inner") -> DataFrame:
    """``rows`` joined on ``key`` with ``other``, whose ``other_key`` is unique.

    The rows of a hot key are dealt by ``salt`` to ``SHARES`` tasks, each with a copy of the key's row of ``other``.
    """
    hot = hot_keys(rows, key)
    if not hot:
        return rows.join(other, F.col(key) == F.col(other_key), how)
    zero = F.lit(0).cast("long")
    dealt = rows.withColumn("s_share", F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(salt), F.lit(SHARES))).otherwise(zero))
    copies = F.when(F.col(other_key).isin(hot), F.sequence(zero, F.lit(SHARES - 1).cast("long"))).otherwise(F.array(zero))
    many = other.withColumn("o_share", F.explode(copies))
    return dealt.join(many, (F.col(key) == F.col(other_key)) & (F.col("s_share") == F.col("o_share")), how).drop("s_share", "o_share")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for edges (a, b) of longs: label is the smallest node that is reachable.

    Every round each node takes the smallest label around it and then its
    label's label, so stars take two rounds and chains a number
    logarithmic in their length.  Rounds are written, and dropped when the next one is there; the driver sees the hot keys and whether
    a label has changed.  The centre of a star and the label of a large component are hot keys, which are dealt to several tasks.
    Nodes without an edge do not appear.
    """
    spark = edges.sparkSession
    before = len(WRITTEN)
    both = written(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        old = WRITTEN[before + 1:]
        around = spread_join(both, "b", labels, "node", "a").groupBy("a").agg(F.min("label").alias("m"))
        near = written(labels.join(around, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"),
                                                                               F.least("label", "m").alias("label")), "near")
        jump = near.select(F.col("node").alias("j_node"), F.col("label").alias("j_label"))
        new = written(spread_join(near, "label", jump, "j_node", "node", "left")
                      .select("node", "old", F.least("label", F.coalesce("j_label", "label")).alias("label")), "labels")
        labels = new.select("node", "label")
        drop_written(spark, [*old, *WRITTEN[-2:-1]])
        if new.where("label <> old").isEmpty():
            drop_written(spark, WRITTEN[before:before + 1])
            return labels
