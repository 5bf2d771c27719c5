"""Declared types of the sources, and what they become."""
