"""Lakehouse ELT on Spark: landed files to standardized Parquet to audience marts."""
