"""Column-level functions (JVM-side expressions only)."""
