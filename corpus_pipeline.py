"""Corpus pipeline over ``documents``; STAGES lists its stages in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and reread as the next stage's docs.  All but the last return the columns of
documents.  A stage works on everything that the one before it kept; the
cases that each operator defines (nulls, empty and long texts, ties, repeated rows,
empty tables, further columns) hold for its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import bpe_digests
from tessera.llm.common import WRITTEN, drop_written, table, written
from tessera.llm.jaccard_join import jaccard_dedup
from tessera.llm.line_dedup import line_dedup
from tessera.llm.mixing import mix
from tessera.llm.quality_rules import quality_filter
from tessera.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified rule reject go."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go, in every document."""
    return line_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays."""
    return jaccard_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once; those of sources below their weight again, as the mix takes them."""
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts, a row for each document of the mix."""
    return bpe_digests(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources", source_mix),
    ("BPE encoding and decoding", tokens),
]

# the tokens and the mix (logarithms in a bisection) are beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to ``documents``; each result but the last is written and reread.

    What a stage has written on its way, and the result that it read, go as soon as its own is there.
    """
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before = len(WRITTEN) - (k > 0)
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k + 1}")
            drop_written(spark, WRITTEN[before:-1])
    return docs
