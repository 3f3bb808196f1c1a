"""Operators for training data: text, urls, pages and vectors.

Nothing outside this folder imports it. ``queries`` holds what the entry point registers.
"""
