"""Readers and writers. Explicit schemas; no schema inference passes."""

from outcomelab.sources.tables import TABLES, read_table, read_csv, read_csv_checked
from outcomelab.sources.sinks import write_checked, write_csv, write_parquet
from outcomelab.sources.logs import read_text_log, scrape_metrics
from outcomelab.sources.profile import load_profile

__all__ = ["TABLES", "read_table", "read_csv", "read_csv_checked",
           "write_checked", "write_csv", "write_parquet", "read_text_log", "scrape_metrics",
           "load_profile"]
