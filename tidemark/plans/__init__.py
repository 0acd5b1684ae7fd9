"""Size checks, ordered prefixes and table layout."""
