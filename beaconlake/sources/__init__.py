"""Table readers and payload parsers."""
