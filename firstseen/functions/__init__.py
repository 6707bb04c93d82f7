"""Column functions: JSON lines, record keys, file and report names."""
