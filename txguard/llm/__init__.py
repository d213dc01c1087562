"""Operators for preparing training text, each with its query. Nothing else in the package imports them."""
