"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Common rules: null text counts as empty; only the named columns are read, so extra columns of any name do not matter;
an empty table gives an empty result of the same columns. What an operator does with repeated rows, null identifiers
and ties stands in its docstring.
"""
