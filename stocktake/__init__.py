"""stocktake: catalogue normalisation and business analytics on Spark.

A wide, all-text product listing is staged under an explicit schema, normalised
into typed dimension, status and bridge tables, checked for key and reference
integrity, and analysed with grouped business reports. Every step is a pure
``DataFrame -> DataFrame`` (or ``Column -> Column``) function built from Spark
built-ins, so Catalyst plans it and the cluster scales it.
"""

__all__ = ["session", "schemas"]
