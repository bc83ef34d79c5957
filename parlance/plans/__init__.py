"""parlance.plans."""
