"""Column-level helpers: regex dialect, rule unions, text shaping."""
