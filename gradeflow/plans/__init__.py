"""Whole flows put together from operators."""
