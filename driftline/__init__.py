"""Text-revision and traffic analytics, written with the Spark DataFrame API."""
