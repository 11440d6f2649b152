"""Column-level helpers (pure expressions, no UDFs unless noted)."""
