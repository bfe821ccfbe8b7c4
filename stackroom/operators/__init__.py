"""DataFrame operators, one module for each stage."""
