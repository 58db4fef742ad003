"""Operators of a training-data pipeline (text, vectors, pages) on Spark.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries only when it can be imported.
"""
