"""Queries of the text problems; names, columns and cases as the test data state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirewright.llm.canonical import canonical_texts
from quirewright.llm.encoding import encode_texts
from quirewright.llm.markup import labelled_blocks
from quirewright.llm.packing import pack
from quirewright.llm.scan_noise import repaired_texts, scan_noise
from quirewright.llm.truncation import truncated_texts, truncation_by_source


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = labelled_blocks(_table(spark, sf_dir, "surya_results"), clean=False)
    return blocks.select("result_id", "prediction_no", "block_no", F.explode("families").alias("family"))


def p1_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_blocks(_table(spark, sf_dir, "surya_results"))


def _scanned(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [_table(spark, sf_dir, name) for name in ("calibration_pages", "pending_surya_pages", "structure_blocks")]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise(*_scanned(spark, sf_dir)).select("table_name", "row_key", "noise").distinct()


def p2_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_texts(*_scanned(spark, sf_dir))


def _calibration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both texts of each calibration page, a row each."""
    pages = _table(spark, sf_dir, "calibration_pages").select("page_key", "reference_text", "tesseract_text")
    return pages.unpivot("page_key", ["reference_text", "tesseract_text"], "field_name", "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_texts(_calibration_texts(spark, sf_dir)).filter("canonical_changed").select("page_key", "field_name")


def p3_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_texts(_calibration_texts(spark, sf_dir)).select("page_key", "field_name", F.col("canonical").alias("text"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(_table(spark, sf_dir, "documents"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = encode_texts(_table(spark, sf_dir, "documents"), counts_only=True)
    return pack(sizes, _table(spark, sf_dir, "pack_capacities"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated_texts(_table(spark, sf_dir, "documents")).filter("cut").select("doc_id")


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_by_source(truncated_texts(_table(spark, sf_dir, "documents")))


QUERIES = {"p1_found": p1_found, "p1_texts": p1_texts, "p2_found": p2_found, "p2_texts": p2_texts, "p3_found": p3_found, "p3_texts": p3_texts, "p6_ids": p6_ids, "p7_containers": p7_containers, "p8_found": p8_found, "p8_sources": p8_sources}
SQL: dict[str, str] = {}
