"""Workflows composed from operators, the stand-in inputs, the query catalog
and its SQL twins."""
