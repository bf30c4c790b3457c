"""Event analytics for e-commerce clickstreams on Spark DataFrames and Structured Streaming."""
