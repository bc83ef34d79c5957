"""parlance.streaming."""
