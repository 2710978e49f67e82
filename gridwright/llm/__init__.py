"""Operators for preparing training text: ten of them, the queries that apply them, and nothing the rest imports."""
