"""modlake: content-moderation event analytics on Spark DataFrames."""
