"""Column functions: no shuffle, no Python workers."""
