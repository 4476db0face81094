"""Preparing record texts as training data: ten operators and their registered queries.

Nothing else in the library imports this package.
"""
