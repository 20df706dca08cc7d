"""Source registry, readers, table access and table writers."""
