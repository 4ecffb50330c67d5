"""The metric itself, its incremental rebuild, and the job that writes it."""
