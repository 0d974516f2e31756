"""Operators for preparing training text: one module each, with its query beside it.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
