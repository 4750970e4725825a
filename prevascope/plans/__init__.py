"""Models built from the operators, and the layered run."""
