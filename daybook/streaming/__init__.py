"""Raw files taken in as they arrive."""
