"""Operators: pure functions DataFrame -> DataFrame (or dict of them)."""
