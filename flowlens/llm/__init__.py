"""Operators for large-scale training-data preparation.

Nothing outside this subpackage imports it; its queries are added to the
registry by ``__spark_entry__`` when the subpackage is present.
"""
