"""Column-expression builders (all built-in Spark expressions, no UDFs)."""
