"""Feed files, written tables, seeds."""
