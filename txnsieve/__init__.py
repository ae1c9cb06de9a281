"""Transaction risk scoring and analysis as Spark DataFrame and Structured Streaming jobs."""
