"""Every operator on the given tables, next to independent SQL for the same result."""
