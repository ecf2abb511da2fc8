"""Plans of whole jobs."""
