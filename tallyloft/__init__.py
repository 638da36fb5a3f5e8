"""Retail analytics on PySpark: medallion batch layer, streaming hot path, serving marts, data quality."""
