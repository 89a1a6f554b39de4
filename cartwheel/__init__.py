"""Shop lakehouse analytics written as plain Spark DataFrame operators."""
