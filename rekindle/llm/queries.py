"""One query per operator over the supplied tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rekindle.llm import (chat, fingerprints, langid, line_chunks, mixing, ngram_join, periodic, pieces, quality, ranking,
                          repair, sharding, simhash)
from rekindle.llm.common import table


def _docs(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_syncmers": _docs(fingerprints.op1_query),
        "op2_line_chunks": _docs(line_chunks.op2_query),
        "op3_mix_sources": _docs(mixing.op3_query),
        "op4_adaptive_rules": _docs(quality.op4_query),
        "op5_stratified_shards": _docs(sharding.op5_query),
        "op6_gram_jaccard": _docs(ngram_join.op6_query),
        "op7_bradley_terry": lambda spark, sf_dir: ranking.op7_query(
            table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op8_gumbel_pieces": _docs(pieces.op8_query),
        "op9_perspectives": lambda spark, sf_dir: chat.op9_query(table(spark, sf_dir, "conversations")),
        "op10_byte_gru": _docs(langid.op10_query),
        "op11_simhash": _docs(simhash.op11_query),
        "op12_auction_repair": lambda spark, sf_dir: repair.op12_query(table(spark, sf_dir, "conversations")),
        "op13_periodic_runs": _docs(periodic.op13_query),
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_gram_jaccard": ngram_join.ORACLE, "op2_line_chunks": line_chunks.ORACLE, "op9_perspectives": chat.ORACLE,
            "op3_mix_sources": mixing.ORACLE, "op4_adaptive_rules": quality.ORACLE,
            "op12_auction_repair": repair.ORACLE}
