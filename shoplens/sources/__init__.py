"""Readers for the canonical tables and writers for the reports."""

from shoplens.sources.canonical import (
    coupon_members,
    date_strings,
    members,
    orders,
    search_log,
)
from shoplens.sources.readers import read_catalog_table, read_parquet_table, read_text_log
from shoplens.sources.sinks import to_json_lines, write_report

__all__ = [
    "coupon_members",
    "date_strings",
    "members",
    "orders",
    "read_catalog_table",
    "read_parquet_table",
    "read_text_log",
    "search_log",
    "to_json_lines",
    "write_report",
]
