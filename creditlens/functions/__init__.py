"""creditlens.functions."""
