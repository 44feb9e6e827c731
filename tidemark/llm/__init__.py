"""Operators for large-scale training-data pipelines.

Thirteen operators, one module each; their registered queries are in
:mod:`tidemark.llm.queries`. Nothing outside this package imports it.
"""
