"""Operators for preparing training data for language models; nothing else in the library imports them."""
