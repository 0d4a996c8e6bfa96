"""Column-level functions: text, time, values and URLs."""
