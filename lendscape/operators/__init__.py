"""Table-agnostic DataFrame operators."""
