"""Column expressions: all run inside Spark's generated code, none is a Python function."""
