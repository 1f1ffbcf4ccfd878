"""Multi-step plans built from operators, and the registry of checked queries."""
