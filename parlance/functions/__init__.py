"""parlance.functions."""
