"""Composite plans: normalisation, reports, and the registered check queries."""
