"""Column functions: URLs, content types, HTML."""
