"""Whole jobs made of sources, functions and operators."""
