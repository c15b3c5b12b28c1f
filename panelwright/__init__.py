"""Entity-by-time panel analytics as plain Spark DataFrame operators."""
