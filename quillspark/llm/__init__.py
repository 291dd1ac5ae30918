"""Operators for preparing training text and its source records."""
