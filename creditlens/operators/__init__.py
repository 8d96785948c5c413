"""creditlens.operators."""
