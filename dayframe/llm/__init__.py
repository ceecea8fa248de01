"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; ``queries.py`` applies them to the given tables.
"""
