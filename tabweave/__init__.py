"""Template-driven tabular ingest on Spark DataFrames."""
