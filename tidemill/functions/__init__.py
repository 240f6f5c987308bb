"""Types and column expressions."""
