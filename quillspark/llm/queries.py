"""Queries of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.abuse import abuse_rates, abuse_scores
from quillspark.llm.leaks import leak_report, leaks
from quillspark.llm.linkage import repeats_on_arrival
from quillspark.llm.matching import match_records
from quillspark.llm.packing import CAPACITY, TOKENIZER, fill_report, pack, token_counts
from quillspark.llm.scans import page_paragraphs, scan_noise
from quillspark.llm.survivorship import best_rows, surviving_records
from quillspark.llm.truncation import cut_share, flag_cut
from quillspark.plans.tables import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_on_arrival(table(spark, sf_dir, "candidates"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "candidates").select("cand_id", "source", "abstract")
    return flag_cut(rows).where("is_cut").select("cand_id")


def p6_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_share(table(spark, sf_dir, "candidates").select("source", "abstract"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_rows(table(spark, sf_dir, "candidates"))


def p7_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surviving_records(table(spark, sf_dir, "candidates"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_counts(table(spark, sf_dir, "documents"), TOKENIZER), CAPACITY)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p8_containers(spark, sf_dir), CAPACITY)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p9_benchmarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where("abusive").select("doc_id")


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "review_labels"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise(table(spark, sf_dir, "ocr_pages"))


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_paragraphs(table(spark, sf_dir, "ocr_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_confidences(spark, sf_dir).select("cand_id", "deposit_id")


def p4_confidences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_records(table(spark, sf_dir, "candidates"), table(spark, sf_dir, "deposits"))


QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_share": p6_share, "p7_found": p7_found, "p7_records": p7_records, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_found": p9_found, "p9_benchmarks": p9_benchmarks, "p10_found": p10_found, "p10_scores": p10_scores, "p10_rates": p10_rates, "p4_found": p4_found, "p4_confidences": p4_confidences, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs}
ORACLES: dict[str, str] = {}
