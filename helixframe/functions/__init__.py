"""Column functions; every one is made of built-in expressions."""
