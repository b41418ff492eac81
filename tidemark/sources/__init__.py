"""Finding and reading input files."""
