"""Relational operators of a change-set run, each a DataFrame -> DataFrame function."""
