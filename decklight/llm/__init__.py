"""Operators that prepare text for language-model training.

Nothing outside this folder imports it, so it can be removed as a whole.
"""
