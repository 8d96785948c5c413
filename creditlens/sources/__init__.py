"""creditlens.sources."""
