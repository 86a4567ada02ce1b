"""Column functions and join helpers that several operators share."""
