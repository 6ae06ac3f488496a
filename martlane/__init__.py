"""Data-mart engine on Spark DataFrames: staging, marts, metrics, governance, checks, ingest."""
