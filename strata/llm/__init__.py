"""Operators for preparing training text at scale, and the queries over them.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when the package can be imported.
"""
