"""Operators for preparing large-model training data.

Each module holds one operator by its own method; ``catalog`` registers one
query per operator.  Nothing outside this package imports it.
"""
