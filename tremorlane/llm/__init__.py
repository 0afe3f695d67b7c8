"""Operators for preparing training text: near and exact copies, tokens, archives, filters."""
