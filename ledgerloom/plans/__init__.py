"""Queries and the commands composed of operators."""
