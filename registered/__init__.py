"""The queries registered in `__spark_entry__.py`, their inputs and their oracle SQL."""
