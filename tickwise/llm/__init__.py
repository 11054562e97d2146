"""Operators for preparing training text.

Nothing else in the library imports this package. ``registry`` holds the
query keys, ``oracle`` their SQL; every other module is one operator.
"""
