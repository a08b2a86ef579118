"""Column-level helpers: missing-value rules, option columns, value labels."""
