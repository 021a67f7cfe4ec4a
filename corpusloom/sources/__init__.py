"""Reading and writing: corpus scans, chunk tables, keyed tables."""
