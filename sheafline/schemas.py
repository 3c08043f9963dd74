"""Schemas of the records that pass between stages, and checks of keys Spark does not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXTRACTION = "filename string, file_type string, title string, text string, page_count int, text_length int, ocr_used boolean, extraction_status string"
DOC_RECORD = "path string, label int, doc_group string, " + EXTRACTION + ", doc_hash string"
PREDICTION = ("filename string, is_module_handbook boolean, score double, decision string, review_status string, extraction_status string, model_version string, "
              "thresholds struct<lower: double, upper: double>")
DOCUMENT_ITEM = "url string, filename string, source_page string, file_type string, content binary, size_bytes int, crawled_at string, job_id string, extra map<string,string>"
CONTENT_ITEM = "url string, title string, text string, fields map<string,string>, crawled_at string, job_id string, extra map<string,string>"
VISITED = "url string, job_id string, scraped_at timestamp_ntz, metadata map<string,string>"
JOB_RESULT = "url string, job_id string, status string, detail string, files_found int, files_downloaded int, bytes_downloaded bigint"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose non-null key no parent has."""
    known = parent.select(*keys).distinct()
    set_ = F.lit(True)
    for k in keys:
        set_ = set_ & F.col(k).isNotNull()
    return child.where(set_).join(known, keys, "left_anti")
