"""Table scans and writers."""
