"""Reports built from the operators, and the registry of named queries."""
