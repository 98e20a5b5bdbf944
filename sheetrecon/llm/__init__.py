"""Training-data operators over ``documents``- and ``pages``-like tables.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
thin registered queries; every operator module has its own general interface.
"""
