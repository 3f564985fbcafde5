"""Table builders, one module per layer."""
