"""Column expressions; all of them are compositions of built-in functions."""
