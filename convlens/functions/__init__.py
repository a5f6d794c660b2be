"""Column expressions: no shuffle, no Python at run time."""
