"""Registered queries, put together from operators, and their oracles in SQL."""
