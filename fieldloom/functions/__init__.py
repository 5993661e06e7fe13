"""Column functions over names, allowed values and item columns."""
