"""Column-to-column expressions (JVM-side, no Python UDFs)."""
