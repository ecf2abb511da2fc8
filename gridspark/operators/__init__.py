"""Operators on tiles, pixels and features."""
