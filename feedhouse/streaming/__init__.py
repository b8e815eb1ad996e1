"""Feed files that arrive in a folder."""
