"""DataFrame-level operators: keys, de-duplication, joins, aggregates, quality."""

from . import aggregates, dedupe, joins, keys, quality  # noqa: F401
