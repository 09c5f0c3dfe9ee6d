"""Training-data operators. Nothing outside this subpackage imports it.

Every operator takes DataFrames and parameters and returns DataFrames; ``queries`` holds the thin
``opN_<name>`` queries and their SQL.
"""
