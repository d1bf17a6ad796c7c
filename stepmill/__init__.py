"""Spark-native data preparation: pipelines of small configured steps over DataFrames."""

from stepmill.operators import columns, crawl, dates, html, nulls, order, profile, records, sketch, strings
from stepmill.plans import listing
from stepmill.plans.fitted import fit_steps
from stepmill.plans.pipeline import transform_data
from stepmill.sinks.csv import append_csv, append_csv_stream, dated_path, stage_export
from stepmill.sources.csv import extract_csv
from stepmill.sources.paged import extract_paged_csv, extract_paged_csv_lite
from stepmill.sources.union import union_pages

__all__ = [
    "append_csv",
    "append_csv_stream",
    "columns",
    "crawl",
    "dated_path",
    "dates",
    "extract_csv",
    "extract_paged_csv",
    "extract_paged_csv_lite",
    "fit_steps",
    "html",
    "listing",
    "nulls",
    "order",
    "profile",
    "records",
    "sketch",
    "stage_export",
    "strings",
    "transform_data",
    "union_pages",
]
