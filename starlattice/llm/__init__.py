"""Operators for large-scale training-data pipelines, one module each.

Nothing else in the library imports this subpackage.
"""
