"""starlattice."""
