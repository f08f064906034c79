"""Real-time user analytics on Spark DataFrames and Structured Streaming."""
