"""Queries over the given tables and the SQL that states what they must return."""
