"""The queries of this subpackage and, where SQL can express them, the SQL that they are held against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .alignment import align_tokens
from .common import documents
from .decontaminate import contamination
from .language import identify
from .lines import ORACLE as LINE_ORACLE
from .lines import line_dedup
from .media import text_media_columns
from .packing import pack
from .phrases import ORACLE as PHRASE_ORACLE
from .phrases import collocations
from .scoring import lm_scores
from .secrets import scan
from .simhash import near_duplicates
from .substrings import remove_repeats
from .urls import ORACLE as URL_ORACLE
from .urls import judge_urls
from .warc import ORACLE as WARC_ORACLE
from .warc import archive_pages


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_media_columns(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_media_columns,
        op2_simhash,
        op3_packing,
        op4_decontamination,
        op5_language,
        op6_suffix_array,
        op7_line_dedup,
        op8_url_filters,
        op9_lm_scoring,
        op10_secret_scans,
        op11_phrases,
        op12_alignment,
        op13_warc,
    )
}
ORACLES: dict[str, str] = {"op7_line_dedup": LINE_ORACLE, "op8_url_filters": URL_ORACLE, "op11_phrases": PHRASE_ORACLE, "op13_warc": WARC_ORACLE}
