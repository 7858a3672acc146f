"""Operators of a large-scale training-data pipeline over text tables.

Nothing outside this subpackage imports it. Each module holds one operator;
``catalog`` registers their queries, ``oracle`` their SQL.
"""
