"""creditlens.plans."""
