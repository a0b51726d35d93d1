"""orgextract: extraction, linking and change detection over web-derived tables, on Spark DataFrames."""
