"""Price-observation analytics as Spark DataFrame operators."""
