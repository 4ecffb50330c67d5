"""Data-quality checks and run monitoring."""
