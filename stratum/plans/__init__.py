"""Layer transformations composed from the operators."""
