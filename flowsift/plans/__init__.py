"""Compositions of operators: pipelines and the query catalogue."""
