"""Column-level functions: text, URLs, admission, robots, HTML."""
