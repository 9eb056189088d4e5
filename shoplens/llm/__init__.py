"""Operators for preparing large-scale training data, on Spark.

One module per operator; ``queries.py`` registers them over the given tables.
Nothing outside this subpackage imports it.
"""
