"""Operators for preparing training data from raw documents, pages and conversations.

Nothing else in the library imports this subpackage.
"""
