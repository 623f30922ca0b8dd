"""Column functions: no shuffle, no Python on the executors."""
