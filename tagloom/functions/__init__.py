"""Column builders: every function here takes and returns ``Column`` objects."""
