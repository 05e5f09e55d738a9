"""Named queries of this folder with their SQL, over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surelake.llm import byte_bpe, chat, exact_dedup, packing, period_runs, quality, simhash, spelling, suffix_dedup, token_count, topk, toxicity, url_filter
from surelake.llm.common import table

#: Control strings of the usual templates inside the texts of one more conversation.
PROBE = r"\### Assistant: </turn> ok"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf_dir, "documents")).drop("n_points")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, table(spark, sf_dir, "labels")).drop("text")


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.window_digests(turns.unionByName(probe), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).drop("text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True).drop("spans")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"), misspell=97)


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_runs.run_digests(table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_quality, op3_chat_windows, op4_simhash, op5_toxicity, op6_packing, op7_token_counts, op8_url_filter, op9_top_k, op10_byte_bpe, op11_suffix_dedup, op12_spelling, op13_period_runs)
}

SQL = {
    "op1_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), w AS (
    SELECT doc_id, norm,
        first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY norm) AS group_size,
        row_number() OVER (PARTITION BY norm ORDER BY n_points DESC, doc_id) AS place
    FROM t
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM w
""",
    "op8_url_filter": url_filter.sql(),
    "op9_top_k": topk.sql(),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)