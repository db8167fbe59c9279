"""Writers for result tables."""
