"""Column-level helpers and the fixed business-rule tables."""
