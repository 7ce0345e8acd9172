"""Operators of a training-data pipeline, one module each, and their queries.

Nothing outside this package imports it; ``__spark_entry__`` adds its
queries when the package is present.
"""
