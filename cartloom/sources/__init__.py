"""Where tables come from and where results go."""

from cartloom.sources.csv import csv_tables, ingest_directory, ingest_once, read_csv, splittable, typed
from cartloom.sources.history import BucketedHistoryTable, HistoryTable
from cartloom.sources.schemas import RAW_SCHEMAS
from cartloom.sources.seeds import read_seed, seed_cities
from cartloom.sources.tables import (
    catalog_summary,
    create_namespace,
    drop_built,
    drop_table,
    namespace_exists,
    quote,
    row_counts,
    save_table,
)

__all__ = [
    "BucketedHistoryTable",
    "HistoryTable",
    "RAW_SCHEMAS",
    "catalog_summary",
    "create_namespace",
    "csv_tables",
    "drop_built",
    "drop_table",
    "ingest_directory",
    "ingest_once",
    "namespace_exists",
    "quote",
    "read_csv",
    "read_seed",
    "row_counts",
    "save_table",
    "seed_cities",
    "splittable",
    "typed",
]
