"""Landing folder: which files are there, what they hold, and how to scan them."""
