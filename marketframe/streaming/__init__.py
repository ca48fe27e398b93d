"""Incremental runs over the article backlog."""

from marketframe.streaming.backlog import read_drained, retry_pending, stream_pending
from marketframe.streaming.keyed import drain_collections, read_collections_drained

__all__ = ["drain_collections", "read_collections_drained", "read_drained", "retry_pending", "stream_pending"]
