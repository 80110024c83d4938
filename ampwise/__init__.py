"""ampwise: fleet telemetry analytics on Spark DataFrames."""
