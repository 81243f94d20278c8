"""The queries of this subpackage over the standard tables, and the SQL that some can be checked against."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .conversation_repair import CONVERSATION_REPAIR_SQL, damage, repair_report
from .embedding_whitening import whitened_components
from .exact_dedup import EXACT_DEDUP_SQL, exact_dedup
from .line_dedup import line_dedup
from .lm_scoring import score_language_model
from .media_png import media_columns
from .packing import best_fit_packing
from .quality_crf import score_quality
from .secret_scan import scan_secrets
from .sentencepiece_codec import encode_and_decode
from .simhash_dedup import simhash_dedup
from .toxicity import score_toxicity
from .url_filters import URL_FILTERS_SQL, filter_urls

#: Folder of the public tokenizer files; by default where the package public_tokenizers is.
TOKENIZERS = "CAPTIONLOOM_TOKENIZERS"


def tokenizer_file(name: str) -> str:
    folder = os.environ.get(TOKENIZERS)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_kept, n_dropped and the numbers of the lines that stay."""
    out = line_dedup(documents(spark, sf_dir), keep_text=False)
    kept = F.array_join(F.col("kept_lines").cast("array<string>"), ",").alias("kept_lines")
    return out.select("doc_id", "n_lines", "n_kept", (F.col("n_lines") - F.col("n_kept")).alias("n_dropped"), kept)


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_language_model(documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), keep_ids=False)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(documents(spark, sf_dir), keep_media=False)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"), digest=True)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return repair_report(damage(given), given).drop("n_rows", "n_repaired")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return scan_secrets(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened_components(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_exact_dedup,
        op2_quality_classifier,
        op3_line_dedup,
        op4_lm_scoring,
        op5_best_fit_packing,
        op6_simhash_near_dedup,
        op7_toxicity,
        op8_media_columns,
        op9_sentencepiece,
        op10_url_filters,
        op11_conversation_repair,
        op12_secret_scan,
        op13_embedding_whitening,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP_SQL, "op10_url_filters": URL_FILTERS_SQL, "op11_conversation_repair": CONVERSATION_REPAIR_SQL}
