"""Operators of a training-data pipeline over documents, vectors and pages.

Nothing outside this folder imports it; ``__spark_entry__.py`` registers its
queries only when it is present.  General helpers (work folder, table scans)
come from the rest of the package.
"""
