"""The registered queries of the operators, one each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tslake.llm import bpe, decontaminate, html_extract, jaccard, languages, licenses, minmax, periodic, quality, search, token_counts, token_files, warc
from tslake.llm.common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.report(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"), periodic.planted_order)


def op13_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.join(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_files": op4_token_files,
    "op5_warc": op5_warc,
    "op6_decontaminate": op6_decontaminate,
    "op7_bpe": op7_bpe,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_token_counts": op9_token_counts,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_minmax_dedup": op13_minmax_dedup,
}

SQL: dict[str, str] = {
    "op2_license_scan": licenses.SQL,
    "op3_quality_rules": quality.SQL,
    "op5_warc": warc.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_ngram_jaccard": jaccard.SQL,
    "op11_ranked_search": search.SQL,
    "op13_minmax_dedup": minmax.SQL,
}
