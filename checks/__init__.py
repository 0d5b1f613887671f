"""Derived bank tables, registered queries and their SQL counterparts."""
