"""Operators that prepare training data for language models.

Nothing outside this package imports it; its queries are added to the registry
only where it can be imported.
"""
