"""Joins, updates and the order of a daily close."""
