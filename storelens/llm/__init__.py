"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage; its queries are in ``llm.queries`` and are added to
the driver's entry file only if the subpackage can be imported.
"""
