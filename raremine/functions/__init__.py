"""Column-expression helpers (JVM-side, no Python per row)."""
