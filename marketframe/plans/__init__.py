"""End-to-end jobs, composed of sources, operators and sinks."""

from marketframe.plans.jobs import (
    build_bar_store,
    chart_figures,
    load_statements,
    summarize_collection,
    summarize_collections,
)

__all__ = ["build_bar_store", "chart_figures", "load_statements", "summarize_collection", "summarize_collections"]
