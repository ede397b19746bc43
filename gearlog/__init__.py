"""Fleet and sensor analytics as Spark DataFrame operators."""
