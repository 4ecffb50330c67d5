"""DataFrame-to-DataFrame operators: latest event per key, date windows, purchase state."""
