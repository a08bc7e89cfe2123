"""The registered queries of this subpackage, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, html_tree, licenses, line_crf, media, packing, quality, repair, simhash, substring, tokens, toxicity
from .shared import read_table


def _documents(apply: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: apply(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": _documents(substring.op1_substring),
    "op2_quality_rules": _documents(quality.op2_quality_rules),
    "op3_simhash": _documents(simhash.op3_simhash),
    "op4_toxicity": lambda spark, sf_dir: toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")),
    "op5_media": media.op5_media,
    "op6_packing": _documents(packing.op6_packing),
    "op7_html_tree": lambda spark, sf_dir: html_tree.extract(read_table(spark, sf_dir, "pages")),
    "op8_licenses": _documents(licenses.license_scan),
    "op9_bpe": _documents(bpe.op9_bpe),
    "op10_token_files": tokens.op10_token_files,
    "op11_line_crf": lambda spark, sf_dir: line_crf.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")),
    "op12_repair": lambda spark, sf_dir: repair.op12_repair(read_table(spark, sf_dir, "conversations")),
    "op13_divergence": _documents(divergence.source_divergence),
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality.OP2_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
