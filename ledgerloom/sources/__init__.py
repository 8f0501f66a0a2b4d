"""Reading files and keeping tables."""
