"""wardline: security-event analytics as Spark DataFrame operators."""
