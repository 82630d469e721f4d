"""Raw landing, hash-gated upsert and update-only patch operators on Spark DataFrames."""
