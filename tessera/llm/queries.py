"""Registered queries of the operators in this folder and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import alignment as align
from tessera.llm import bpe
from tessera.llm import exact_dedup as exact
from tessera.llm import jaccard_join as jaccard
from tessera.llm import importance
from tessera.llm import language_id as langid
from tessera.llm import line_dedup as lines
from tessera.llm import licenses, mixing, pieces
from tessera.llm import quality_rules as quality
from tessera.llm import suffix_dedup as suffix
from tessera.llm import toxicity as toxic
from tessera.llm.common import table


def tokenizer_file() -> str:
    """The byte-level tokenizer of the public tokenizer files; they lie at the same place on every machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_file() -> str:
    """The piece model of the public tokenizer files."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), tokenizer_file())


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup_report(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup_digests(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_report(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_scores(table(spark, sf_dir, "documents"), tokenizer_file(), piece_file())


def op12_piece_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), piece_file())


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_encode_decode": op1_bpe_encode_decode,
    "op2_language_id": op2_language_id,
    "op3_line_dedup": op3_line_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_source_mixing": op6_source_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_piece_encode_decode": op12_piece_encode_decode,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = {
    "op3_line_dedup": lines.ORACLE,
    "op4_license_scan": licenses.ORACLE,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op13_importance_resampling": importance.ORACLE,
}
