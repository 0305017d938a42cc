"""Credit-risk analytics written as Spark DataFrame, MLlib and Structured Streaming jobs."""
