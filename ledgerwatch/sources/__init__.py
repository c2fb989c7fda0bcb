"""Reading and writing stored tables."""
