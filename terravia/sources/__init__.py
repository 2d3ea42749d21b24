"""Layer readers and writers."""
