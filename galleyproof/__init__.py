"""Editorial workflow analytics as Spark DataFrame operators."""
