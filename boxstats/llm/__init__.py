"""Training-data operators: ten corpus transforms and the queries that register them.

Nothing else in the library imports this subpackage.
"""
