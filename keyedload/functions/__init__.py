"""Column functions: placement tokens and value conversion."""
