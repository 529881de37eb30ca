"""Column functions. Each takes and returns Columns and runs inside the JVM."""
