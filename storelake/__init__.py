"""Retail lakehouse jobs on PySpark: Bronze files, Silver tables, a Gold star schema and streams."""
