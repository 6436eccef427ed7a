"""Composed jobs: the stored pipeline, the query registry and its SQL checks."""
