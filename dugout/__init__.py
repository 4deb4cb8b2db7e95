"""Box-score and play-by-play analytics on Spark DataFrames."""
