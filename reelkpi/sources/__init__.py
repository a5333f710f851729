"""Where film records come from and where tables go: parquet tables, landed JSON, CSV."""
