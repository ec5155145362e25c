"""The numbered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticketmill.llm import (languages, licences, lines, minhash, mixing, neighbours, pieces, quality, repeats,
                            toxicity, variants, whitening, wrappers)


def _over(table: str, fn: Callable[[DataFrame], DataFrame]):
    return lambda spark, sf_dir: fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": _over("documents", lines.digest),
        "op2_nearest": _over("embeddings", neighbours.search),
        "op3_sentencepiece": _over("documents", pieces.digest),
        "op4_suffix_dedup": _over("documents", repeats.digest),
        "op5_source_mix": _over("documents", mixing.shares),
        "op6_minhash_dedup": _over("documents", minhash.by_four_words),
        "op7_toxicity": lambda spark, sf_dir: toxicity.scored(
            spark.read.parquet(f"{sf_dir}/documents.parquet"),
            spark.read.parquet(f"{sf_dir}/labels.parquet")),
        "op8_quality_rules": _over("documents", quality.verdicts),
        "op9_licence_scan": _over("documents", licences.scan),
        "op10_html_text": _over("pages", wrappers.extract),
        "op11_language": _over("documents", languages.predicted),
        "op12_spelling_variants": _over("documents", variants.grouped),
        "op13_whitening": _over("embeddings", whitening.whiten),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": lines.SQL,
        "op2_nearest": neighbours.SQL,
        "op4_suffix_dedup": repeats.SQL,
        "op5_source_mix": mixing.SQL,
        "op6_minhash_dedup": minhash.SQL,
        "op12_spelling_variants": variants.SQL,
    }
