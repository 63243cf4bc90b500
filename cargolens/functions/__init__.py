"""Column functions: all built on JVM-side expressions."""
