"""Customer-survey analytics as Spark DataFrame operators."""
