"""Column expressions. All are built-in Spark expressions, none needs a Python worker."""
