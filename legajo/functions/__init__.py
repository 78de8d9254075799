"""Column functions; none of them uses a Python UDF."""
