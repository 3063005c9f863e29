"""forgelens: analytics over code-hosting activity, expressed as Spark DataFrames."""
