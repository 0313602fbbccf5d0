"""Incremental runs on Structured Streaming."""

from .incremental import (
    merge_statistics, stream_reference_documents, stream_statistics_csv, stream_trending_documents,
    update_reference, update_statistics,
)

__all__ = [
    "merge_statistics", "stream_reference_documents", "stream_statistics_csv",
    "stream_trending_documents", "update_reference", "update_statistics",
]
