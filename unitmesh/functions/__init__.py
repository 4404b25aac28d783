"""Column-level helpers (JVM expressions) and the one vectorised UDF (Jaro)."""
