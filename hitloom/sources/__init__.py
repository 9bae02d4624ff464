"""Reading the exports and writing the marts."""
