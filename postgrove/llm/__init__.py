"""Operators for preparing training data for language models.

Each module holds one operator as functions on DataFrames, ``queries`` applies
them to the test tables. Nothing else in the library imports this subpackage.
"""
