"""Column helpers: every function maps Column to Column and stays inside the JVM."""

from marketframe.functions.formats import capitalized, change_text, day_text, rupiah, storage_name
from marketframe.functions.numbers import percent_change, safe_double, safe_ratio
from marketframe.functions.text import (
    chunk_text,
    clean_text,
    is_blank,
    join_in_order,
    lead_sentences,
    strip,
)
from marketframe.functions.variants import first_truthy, is_object, kind_of, to_number, to_text, truthy

__all__ = [
    "capitalized",
    "change_text",
    "chunk_text",
    "clean_text",
    "day_text",
    "first_truthy",
    "is_blank",
    "is_object",
    "join_in_order",
    "kind_of",
    "lead_sentences",
    "percent_change",
    "rupiah",
    "safe_double",
    "safe_ratio",
    "storage_name",
    "strip",
    "to_number",
    "to_text",
    "truthy",
]
