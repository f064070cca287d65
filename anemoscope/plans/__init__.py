"""Whole analyses and runs put together from the operators."""
