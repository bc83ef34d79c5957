"""parlance.operators."""
