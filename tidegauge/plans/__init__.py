"""Ready-made analyses and the registry of checked queries."""
