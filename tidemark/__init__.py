"""Cut-over backfill engine on Spark DataFrames."""
