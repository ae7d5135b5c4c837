"""Reusable DataFrame operators: cleaning, features, roll-ups, exact ranks, quality checks."""
