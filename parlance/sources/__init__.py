"""parlance.sources."""
