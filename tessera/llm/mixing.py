"""Mixing sources to target weights by temperature.

A source with the share q of all tokens (words) gets a weight in proportion to
q ** a.  a = 1 keeps the natural shares, a = 0 levels all sources, so entropy and
repetition both grow as a falls.  Bisection finds the a that reaches
``target_entropy`` (of the highest possible), held back where a source
would have to be repeated more than ``max_repeats`` times.

The budget is ``budget_tokens`` or, by default, the least with which every
source is read once in full, so that no document is lost.  A source
with weight w then makes w * budget / tokens passes.  Whole passes take every
document once; the last, partial pass takes documents in a hashed order up to
its budget, at a boundary of ``CELLS`` cells of that order.  A pass is spread over its
part of the mix by another hashed order per pass, which deals
the copies to blocks of ``block_tokens``; each block is a permutation
in itself.  So every block holds the sources in their weights, and nothing is
sorted or collected by source: a source that holds a third of the rows costs no more than its rows.

The driver sees one row per source.  Up to ``MAX_BROADCAST_SOURCES`` rows the
plan is broadcast, beyond that it is joined by shuffle, with the same result.

Defined cases: null source is a source of its own; null, empty and blank texts
have no tokens and are in every whole pass, once at least; a source without tokens makes
one pass; rows that repeat count and are dealt like any other rows (ties in a block are
ordered by id); empty tables give empty results; other columns
pass through ``mix`` under any name.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import small_table, words, written

TARGET_ENTROPY = 0.97
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
BLOCK_ROWS = 1 << 17
CELLS = 1024
MAX_BROADCAST_SOURCES = 10_000
STEPS = 60


def weights(tokens: list[int], exponent: float) -> list[float]:
    total = sum(tokens)
    raw = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / sum(raw) for r in raw]


def entropy_share(w: list[float]) -> float:
    """Entropy over that of equal weights; 1 for a single source."""
    n = sum(1 for x in w if x)
    return -sum(x * math.log(x) for x in w if x) / math.log(n) if n > 1 else 1.0


def passes(tokens: list[int], w: list[float], budget: float | None) -> list[float]:
    """Passes of every source; the default budget reads the least favoured source once."""
    if budget is None:
        budget = max(t / x for t, x in zip(tokens, w) if t)
    return [x * budget / t if t else 1.0 for t, x in zip(tokens, w)]


def solve_exponent(tokens: list[int], target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
                   budget: float | None = None) -> float:
    """The largest exponent that reaches the entropy, or the smallest that respects the repetition limit if that is larger."""
    def smallest(ok) -> float:  # ok holds from some exponent upwards
        lo, hi = 0.0, 1.0
        if ok(lo):
            return lo
        for _ in range(STEPS):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if ok(mid) else (mid, hi)
        return hi
    if entropy_share(weights(tokens, 1.0)) >= target_entropy:
        by_entropy = 1.0
    else:
        by_entropy = smallest(lambda a: entropy_share(weights(tokens, a)) < target_entropy)
    by_repeats = smallest(lambda a: max(passes(tokens, weights(tokens, a), budget)) <= max_repeats)
    return max(by_entropy, by_repeats)


def _base(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    return docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.size(words(F.col(text_col))).cast("long").alias("tokens"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"))


def _cell(h: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("last"), h), F.lit(CELLS)).cast("int")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
         target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
         budget_tokens: float | None = None) -> list[tuple]:
    """(source, tokens, weight, passes, whole passes, cells of the last pass, documents) for each source."""
    hist = written(_base(docs, id_col, text_col, source_col, seed).groupBy("source", _cell(F.col("h")).alias("cell"))
                   .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mix")
    counted = hist.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).collect()  # a row per source
    totals = sorted(((r["source"], r["tokens"]) for r in counted), key=lambda r: (r[0] is None, r[0] or ""))
    rows = {r["source"]: r["rows"] for r in counted}
    tokens = [t for _, t in totals]
    if not sum(tokens):
        return [(s, 0, 0.0, 1.0, 1, 0, rows[s]) for s, _ in totals]
    w = weights(tokens, solve_exponent(tokens, target_entropy, max_repeats, budget_tokens))
    e = [max(x, 1.0) if budget_tokens is None else x for x in passes(tokens, w, budget_tokens)]  # 1 but for rounding
    room = small_table(docs.sparkSession, p_source=(pa.string(), [s for s, _ in totals]),
                       room=(pa.float64(), [(x - math.floor(x)) * t for (_, t), x in zip(totals, e)]))
    run = F.sum("tokens").over(Window.partitionBy("source").orderBy("cell"))  # at most CELLS rows per source
    taken = {r["source"]: r["cells"] for r in hist.withColumn("run", run)
             .join(room, F.col("source").eqNullSafe(F.col("p_source"))).where("room > 0 and run <= room")
             .groupBy("source").agg((F.max("cell") + 1).alias("cells")).collect()}
    return [(s, t, x, p, math.floor(p), taken.get(s, 0), rows[s]) for (s, t), x, p in zip(totals, w, e)]


def _copies(docs: DataFrame, rows: list[tuple], id_col: str, text_col: str, source_col: str, seed: int,
            block_tokens: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each copy of a document: row, id, source, tokens, weight, pass, block, order_key."""
    spark = docs.sparkSession
    kinds = {"p_source": pa.string(), "p_tokens": pa.int64(), "weight": pa.float64(), "passes": pa.float64(), "whole": pa.int32(),
             "cells": pa.int32()}
    table = small_table(spark, **{c: (kind, [r[k] for r in rows]) for k, (c, kind) in enumerate(kinds.items())})
    if len(rows) <= MAX_BROADCAST_SOURCES:
        table = F.broadcast(table)
    # a block is bounded in tokens and in rows, as documents without tokens have places too
    blocks = max(1, math.ceil(sum(t * p for _, t, _, p, _, _, _ in rows) / block_tokens),
                 math.ceil(sum(n * p for *_, p, _, _, n in rows) / block_rows))
    got = _base(docs, id_col, text_col, source_col, seed).join(table, F.col("source").eqNullSafe(F.col("p_source")))
    last = F.when(_cell(F.col("h")) < F.col("cells"), F.array(F.col("whole"))).otherwise(F.array().cast("array<int>"))
    whole = F.when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole") - 1)).otherwise(F.array().cast("array<int>"))
    got = got.withColumn("pass", F.explode(F.concat(whole, last)))
    spread = F.pmod(F.xxhash64("h", "pass"), F.lit(1 << 40)) / float(1 << 40)
    partial = F.pmod(F.xxhash64(F.lit("last"), "h"), F.lit(CELLS)) / float(CELLS)  # of the last pass only these cells are there
    at = F.when(F.col("pass") < F.col("whole"), (F.col("pass") + spread) / F.col("passes")) \
        .otherwise((F.col("whole") + (partial + spread / CELLS)) / F.col("passes"))
    return got.select("row", "id", "source", "tokens", "weight", "pass",
                      F.least(F.floor(at * blocks), F.lit(blocks - 1)).cast("long").alias("block"),
                      F.xxhash64(F.lit("order"), "h", "pass").alias("order_key"))


def mix_report(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 11, block_rows: int = BLOCK_ROWS, **goal) -> DataFrame:
    """Per copy: doc_id, source, n_tokens, weight of the source, pass, block, position in the block."""
    docs = docs.select("doc_id", "source", "text")
    rows = plan(docs, seed=seed, **goal)
    got = _copies(docs, rows, "doc_id", "text", "source", seed, block_tokens, block_rows).drop("row")
    place = F.row_number().over(Window.partitionBy("block").orderBy("order_key", "id", "pass"))  # a block is bounded by its budget
    return got.select(F.col("id").alias("doc_id"), "source", F.col("tokens").alias("n_tokens"), "weight", "pass", "block",
                      place.cast("long").alias("position"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
        **goal) -> DataFrame:
    """The documents, each as often as the mix takes it, with all their columns."""
    rows = plan(docs, id_col, text_col, source_col, seed, **goal)
    return _copies(docs, rows, id_col, text_col, source_col, seed, BLOCK_TOKENS).select("row.*")
