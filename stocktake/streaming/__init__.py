"""Incremental loading with Structured Streaming (insert-if-absent dimensions)."""

from . import incremental  # noqa: F401
