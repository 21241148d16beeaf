"""Procurement analytics on Spark: DataFrame-to-DataFrame operators over tender tables."""
