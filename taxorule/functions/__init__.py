"""Expression building blocks as Spark SQL text (all JVM-side, no Python UDFs)."""
