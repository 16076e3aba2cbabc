"""Column helpers that stay JVM-side (no Python UDFs)."""
