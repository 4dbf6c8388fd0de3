"""Composite jobs (the reference's user-visible entry points) and the query registry."""
