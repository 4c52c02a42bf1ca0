"""The append sink as a file stream."""

from .append import batch_counts, numbered_pages, stream_extracts, stream_numbered

__all__ = ["batch_counts", "numbered_pages", "stream_extracts", "stream_numbered"]
