"""Operators that prepare text for training language models.

Nothing else in the library imports this subpackage. ``queries.py`` registers one query
per operator; each operator has its own module and a general interface.
"""
