"""Test inputs only: the given tables mapped to order lines, and the SQL they are checked against."""
