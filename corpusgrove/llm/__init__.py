"""Operators for preparing training data, each built by one named method.

Nothing outside this subpackage imports it.  Operators take DataFrames and
parameters; ``queries`` applies them to the given tables.
"""
