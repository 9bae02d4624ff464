"""The marts."""
