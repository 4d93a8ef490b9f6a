"""Column helpers: cleaning, conversions, list parsing and report tiers."""

from . import clean, tiers  # noqa: F401
