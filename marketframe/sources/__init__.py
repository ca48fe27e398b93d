"""Readers: every function returns a lazy DataFrame with an explicit schema."""

from marketframe.sources.articles import read_articles, read_collections
from marketframe.sources.prices import read_bars, read_prices, read_store, read_universe, read_wide_files
from marketframe.sources.statements import read_raw_statements, read_records, read_statements, rejected_records

__all__ = [
    "read_articles",
    "read_bars",
    "read_collections",
    "read_prices",
    "read_raw_statements",
    "read_records",
    "read_statements",
    "read_store",
    "read_universe",
    "read_wide_files",
    "rejected_records",
]
