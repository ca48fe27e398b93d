"""Writers.  None of them collects rows; counts come from the write itself."""

from marketframe.sinks.bars import write_bars
from marketframe.sinks.tables import (
    write_article_version,
    write_raw_statements,
    write_records_json,
    write_statements,
)

__all__ = [
    "write_article_version",
    "write_bars",
    "write_raw_statements",
    "write_records_json",
    "write_statements",
]
