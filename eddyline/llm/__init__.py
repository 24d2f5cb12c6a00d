"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage; it may be deleted as a whole.
"""
