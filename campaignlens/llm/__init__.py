"""Operators for preparing training text, and the queries that register them.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when it is present.
"""
