"""Writers: bronze append, silver snapshots, gold day partitions and tables."""
