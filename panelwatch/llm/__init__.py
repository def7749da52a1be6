"""Operators for preparing training text at scale (self-contained subpackage)."""
