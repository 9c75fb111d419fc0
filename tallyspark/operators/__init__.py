"""Operators over statement tables and holdings, as DataFrame transformations."""
