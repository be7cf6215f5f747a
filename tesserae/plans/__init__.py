"""Schema compilation and record validation."""
