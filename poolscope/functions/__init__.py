"""Column functions: each takes and returns Spark columns and stays inside the JVM."""
