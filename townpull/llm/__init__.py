"""Operators of a large-scale training-data pipeline (one module per operator).

Nothing else in the package imports this subpackage; ``townpull.llm.catalog`` holds the
registered queries and their SQL.
"""
