"""The registered queries of this package: each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from answerclock.llm import (
    alignment,
    decontaminate,
    dedup_minmax,
    language_id,
    mixing,
    pseudonyms,
    quality_cascade,
    run_index,
    secret_scan,
    spelling,
    substring_dedup,
    token_binary,
    url_filter,
)
from answerclock.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]

# Production parameters that are no default of the operators.
TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"
END_ID = 2
# A key for the registered query only; a real corpus takes its own from a secret store.
PSEUDONYM_KEY = "registered query"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_minmax_dedup(spark, sf_dir):
    return dedup_minmax.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality_cascade.judged(_table(spark, sf_dir, "documents")).drop("failed_rule")


def op3_mixing(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_url_filter(spark, sf_dir):
    found = url_filter.judged(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict", "label", "held_out")


def op5_language_id(spark, sf_dir):
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return substring_dedup.remove_repeats(docs).drop("spans")


def op7_secret_scan(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))


def op8_token_binary(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return token_binary.round_trip(docs, tokenizer_path(), END_ID)


def op9_pseudonyms(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pseudonyms.digest(pseudonyms.pseudonymise(docs, PSEUDONYM_KEY))


def op10_decontamination(spark, sf_dir):
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, items))


def op11_alignment(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return alignment.alignment(docs, tokenizer_path(), tokenizer_path(OTHER_TOKENIZER))


def op12_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op13_run_index(spark, sf_dir):
    return run_index.remove_repeats(_table(spark, sf_dir, "documents"))


_REGISTERED = [
    op1_minmax_dedup,
    op2_quality_rules,
    op3_mixing,
    op4_url_filter,
    op5_language_id,
    op6_substring_dedup,
    op7_secret_scan,
    op8_token_binary,
    op9_pseudonyms,
    op10_decontamination,
    op11_alignment,
    op12_spelling,
    op13_run_index,
]


def queries() -> dict[str, Query]:
    return {query.__name__: query for query in _REGISTERED}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
