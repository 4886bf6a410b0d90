"""Event-driven credit decisioning and its analytics on PySpark DataFrames."""
