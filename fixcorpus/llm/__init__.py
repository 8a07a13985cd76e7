"""Operators for preparing training data from fix records and documents.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""
