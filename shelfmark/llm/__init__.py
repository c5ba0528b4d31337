"""Operators for preparing training text: one module each, queries and SQL in ``queries``."""
